"""Work of the models that must not grow with wedges, months or the number of models."""

import random

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from ledgerlens.operators import features, graph
from ledgerlens.sources import fixture_dictionary

A, B, C = 1, 2, 3


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def log(make_payments):
    rng = random.Random(11)
    rows = [(rng.randrange(30), rng.randrange(30), rng.randrange(900), rng.choice(["pizza", "taxi", "x"])) for _ in range(400)]
    return make_payments([(a, b, d, t) for a, b, d, t in rows if a != b])


def test_triangle_late_for_two_corners_counts_at_the_one_that_started_late(make_payments):
    p = make_payments([(A, B, 0), (A, C, 500), (B, C, 520)])
    assert as_dict(graph.new_triangles(p), ["user1", "lifetime"], "num_triangles") == {(C, 1): 1.0}
    late = make_payments([(A, B, 0), (A, C, 0), (B, C, 0), (A, 4, 0), (B, 4, 1), (4, C, 900)])
    assert as_dict(graph.new_triangles(late), ["user1", "lifetime"], "num_triangles") == {
        (A, 0): 1.0, (B, 0): 1.0, (C, 0): 1.0, (A, 1): 1.0, (B, 1): 1.0, (4, 1): 1.0
    }
    assert graph.triangles(late).count() == 4


def test_late_wedges_are_dropped_where_they_are_made(log):
    """The month is tested in the wedge join, before its rows are shuffled, and no start date is joined to a corner."""
    months = graph.triangle_month(log).where("lifetime <= 12").groupBy("user1", "lifetime").agg(F.count("*").cast("double").alias("n"))
    new = graph.new_triangles(log)
    assert as_dict(new, ["user1", "lifetime"], "num_triangles") == as_dict(months, ["user1", "lifetime"], "n")
    wedge_join = [line for line in _plan(new).splitlines() if "Join Inner" in line and "<= 12" in line]
    assert wedge_join, _plan(new)


def test_friends_of_friends_use_no_array_functions_and_no_anti_join(log):
    plan = _plan(graph.fof_new(log, keep_null=False))
    assert "array_min" not in plan and "LeftAnti" not in plan, plan
    split = graph.fof_first_met(log, keep_null=False).alias("f").join(
        graph.first_met(log).alias("m"),
        F.expr("f.user1 = m.user1 and f.friend_of_friend = m.user2 and f.lifetime = m.lifetime"),
        "left_anti",
    )
    assert sorted(map(tuple, graph.fof_new(log, keep_null=False).collect())) == sorted(map(tuple, split.collect()))


def test_running_lists_are_the_panels(log):
    for op, name in (
        (graph.cum_friends, "cum_num_friends"),
        (graph.cum_triangles, "cum_num_triangles"),
    ):
        lists = op(log, lists=True).select("user1", F.posexplode(name).alias("lifetime", name))
        assert as_dict(lists, ["user1", "lifetime"], name) == as_dict(op(log), ["user1", "lifetime"], name)


def test_models_read_the_stored_months(make_payments, log):
    dic = fixture_dictionary(log.sparkSession)
    fresh = make_payments([tuple(r)[:2] + ((r.datetime - log.agg(F.min("datetime")).first()[0]).days, r.description) for r in log.collect()])
    before = sorted(map(tuple, features.model2_input(fresh, dic).collect()))
    features.keep_monthly(fresh, dic)
    after = features.model2_input(fresh, dic)
    assert sorted(map(tuple, after.collect())) == before
    assert "description" not in _plan(after)
    assert sorted(map(tuple, features.model1_input(fresh).collect())) == sorted(
        (r[0], r[1], r[2], r[3], r[-1]) for r in before
    )
