"""Joins on a user: with a hub in a third of all rows and nothing broadcast, the runtime planner splits it."""

import random

import pytest

from ledgerlens.operators import clock, features, graph, profile
from ledgerlens.sources import fixture_dictionary

# Sizes at which a few thousand rows count as skewed.
SMALL = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.files.maxPartitionBytes": "16k",
    "spark.sql.files.openCostInBytes": "1k",
}


@pytest.fixture(scope="module")
def hub_log(spark, make_payments):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    rng = random.Random(3)
    rows = [(0, u, rng.randrange(300), rng.choice(["cold", "rod", "bolt"])) for u in range(1, 2001)]
    rows += [(rng.randrange(1, 2001), rng.randrange(1, 2001), rng.randrange(300), "gear") for _ in range(4000)]
    log = make_payments([r for r in rows if r[0] != r[1]]).repartition(8)
    yield log
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


CASES = {
    "D4 lifetime_month": lambda p, d: profile.category_rows(p, d),
    "E2 friend_list": lambda p, d: graph.friend_list(p),
    "E6 both_clock": lambda p, d: graph.both_clock_rows(p),
    "E7 first_met": lambda p, d: graph.first_met(p),
    "E16 first_edges": lambda p, d: graph.first_edges(p),
    "E17 triangles": lambda p, d: graph.triangles(p),
    "E18 triangle_month": lambda p, d: graph.triangle_month(p),
    "F2 sender_clock": lambda p, d: clock.sender_clock(p),
    "F10 dual_clock": lambda p, d: clock.dual_clock(p),
    "F11 friend_profile": lambda p, d: features.friend_profile(p, d),
    "F13 network_profile": lambda p, d: features.network_profile(p, d),
}


@pytest.mark.parametrize("name", CASES)
def test_a_hub_is_split(spark, hub_log, name):
    df = CASES[name](hub_log, fixture_dictionary(spark))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan


def test_both_clock_moves_the_log_once(spark, hub_log):
    """Start dates come from a stored table; the join itself shuffles each side once."""
    df = graph.both_clock_rows(hub_log)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan
