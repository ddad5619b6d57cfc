
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import graph, profile, rank
from ledgerlens.schema import PROFILE_COLUMNS
from ledgerlens.sources import derive_payments, fixture_dictionary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def payments(spark):
    return derive_payments(spark, SF).cache()


def test_shares_sum_to_one_within_rounding(spark, payments):
    share = profile.category_share(payments, fixture_dictionary(spark))
    sums = share.groupBy("user1").agg(F.sum("ratio").alias("s")).collect()
    assert all(abs(r.s - 1.0) <= 0.05 for r in sums)


def test_panels_have_13_rows_and_never_decrease(payments):
    for fn, col in [
        (graph.cum_friends, "cum_num_friends"),
        (graph.cum_fof, "cum_num_fnd_of_fnd"),
        (graph.cum_triangles, "cum_num_triangles"),
    ]:
        rows = fn(payments).collect()
        by_user = {}
        for r in rows:
            by_user.setdefault(r.user1, []).append((r.lifetime, r[col]))
        assert all(len(v) == 13 for v in by_user.values())
        for v in by_user.values():
            vals = [c for _, c in sorted(v)]
            assert vals == sorted(vals)


def test_clustering_coefficient_in_unit_interval(payments):
    cc = graph.clustering_coefficient(payments).where(F.col("cluster_coefficient").isNotNull())
    lo, hi = cc.agg(F.min("cluster_coefficient"), F.max("cluster_coefficient")).first()
    assert 0.0 <= lo and hi <= 1.0


def test_corner_rows_are_three_per_triangle(payments):
    assert graph.triangle_month(payments).count() == 3 * graph.triangles(payments).count()


def test_pagerank_sums_to_one(payments):
    total = rank.page_rank(payments, max_iter=30, tol=None).agg(F.sum("PageRank")).first()[0]
    assert abs(total - 1.0) < 1e-9
    monthly = rank.page_rank_by_month(payments, max_iter=10, tol=None)
    for r in monthly.groupBy("lifetime").agg(F.sum("page_rank").alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-9


def test_cumulative_profile_rows_sum_to_one(spark, payments):
    cp = profile.cumulative_profile(payments, fixture_dictionary(spark))
    total = sum(F.col(c) for c in PROFILE_COLUMNS)
    bad = cp.where(F.abs(total - F.lit(1.0)) > 1e-9).count()
    assert bad == 0
