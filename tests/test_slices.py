"""Disk of joins through users: what they shuffle is bounded by slices and goes when a slice is stored."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features, graph, regress
from ledgerlens.schema import PROFILE_COLUMNS
from ledgerlens.session import materialize
from ledgerlens.sources import fixture_dictionary


def _rows():
    rng = random.Random(8)
    rows = [(0, u, rng.randrange(300)) for u in range(1, 80)]
    rows += [(rng.randrange(120), rng.randrange(120), rng.randrange(500), rng.choice(["pizza", "bolt", "gear"])) for _ in range(400)]
    return [r for r in rows if r[0] != r[1]]


def _sliced(monkeypatch, rows=3000):
    monkeypatch.setattr(graph, "SLICE_ROWS", rows)
    monkeypatch.setattr(graph, "SLICE_PAIRS", 1)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_stored_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    materialize(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count().repartition(3, "k"))
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before


@pytest.mark.parametrize("how", [{}, {"hub_block": 7}, {"task_rows": 500}, {"hub_block": 7, "task_rows": 200}])
@pytest.mark.parametrize("sliced", [False, True])
def test_two_hops_whatever_the_slices_blocks_and_tasks(make_payments, monkeypatch, how, sliced):
    friends = defaultdict(set)
    for a, b, *_ in _rows():
        friends[a].add(b)
        friends[b].add(a)
    reached = {(u, w) for u, known in friends.items() for v in known for w in friends[v]}
    if sliced:
        _sliced(monkeypatch)
    p = make_payments(_rows())
    assert (graph.graph_of(p).slices > 2) == sliced
    two = graph.two_hop(p, **how)
    assert sorted(map(tuple, two.collect())) == sorted(reached)
    assert any("/two-hops-" in f for f in two.inputFiles()) == sliced
    only = sorted(map(tuple, graph.two_hop_only(p, **how).collect()))
    assert only == sorted((u, w) for u, w in reached if w not in friends[u])


def test_paths_of_two_steps_are_shuffled_as_lists(make_payments):
    """A row per list and friend goes through the exchange, not one per path; E4 joins nothing with the ends."""
    p = make_payments(_rows())
    for df in (graph.two_hop(p), graph.two_hop_only(p)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Aggregate") < plan.index("Generate explode(fars") < plan.index("RepartitionByExpression"), plan
        assert "LeftAnti" not in plan


def _sorted(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_network_profile_is_the_same_in_slices(spark, make_payments, monkeypatch):
    plain = _sorted(features.network_profile(make_payments(_rows()), fixture_dictionary(spark)))
    _sliced(monkeypatch)
    made = features.network_profile(make_payments(_rows()), fixture_dictionary(spark))
    assert _sorted(made) == plain and len(plain) > 1000
    assert len({f.rsplit("/", 2)[1] for f in made.inputFiles() if "/network-profile-" in f}) > 2


def test_slices_of_friends_of_friends_count_the_same(make_payments, monkeypatch):
    plain = _sorted(graph.cum_fof(make_payments(_rows()), lists=True))
    _sliced(monkeypatch)
    made = graph.cum_fof(make_payments(_rows()), lists=True)
    assert any("/fof-months-" in f for f in made.inputFiles())
    assert _sorted(made) == plain
    with pytest.raises(ValueError, match="slice"):
        graph.fof_new(make_payments(_rows()), cut=lambda rows: rows)


def test_each_model_is_fitted_and_stored_before_the_next(make_payments):
    """One plan for all models would keep the shuffles of all panels on disk at once."""
    panel = features.model1_input(make_payments(_rows()))
    series = regress.mse_series({1: panel, 2: panel.select("*", *[F.lit(0.5).alias(c) for c in PROFILE_COLUMNS])})
    assert {"fit-1", "fit-2"} == {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in series.inputFiles()}
