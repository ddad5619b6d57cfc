"""Graphs that one task holds are iterated there, larger ones by rounds of the cluster (F1)."""

import random

import pytest

from ledgerlens.operators import rank


def _months(p, **how):
    return {(r.user1, r.lifetime): r.page_rank for r in rank.page_rank_by_month(p, **how).collect()}


@pytest.fixture
def log(make_payments):
    rng = random.Random(5)
    rows = [(0, u, rng.randrange(300)) for u in range(1, 200)]
    rows += [(rng.randrange(1, 400), rng.randrange(1, 400), rng.randrange(400)) for _ in range(500)]
    return make_payments([r for r in rows if r[0] != r[1]])


def test_monthly_ranks_of_a_small_graph_do_not_start_jobs_by_the_round(spark, log):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "ranks")
    _months(log, settled=True)
    jobs = len(tracker.getJobIdsForGroup("ranks"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 2 * rank.SETTLED_ROUNDS


@pytest.mark.parametrize("how", [{"settled": True}, {}, {"max_iter": 7, "tol": None}])
def test_tasks_and_rounds_give_the_same_ranks(log, monkeypatch, how):
    """All graphs in tasks, the first months only, none; the hub's edges are salted in the rounds."""
    tasks = _months(log, **how)
    assert len(tasks) > 3000
    for most in (500,) if how else (500, 0):
        monkeypatch.setattr(rank, "TASK_EDGES", most)
        rounds = _months(log, **how)
        assert rounds.keys() == tasks.keys()
        assert max(abs(rounds[k] - tasks[k]) for k in tasks) < 1e-13


def test_rounds_report_no_convergence(spark, monkeypatch):
    monkeypatch.setattr(rank, "TASK_EDGES", 0)
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2)], "src long, dst long")
    with pytest.raises(RuntimeError, match="did not reach"):
        rank.pagerank(edges, max_iter=2, tol=1e-12)


def test_an_end_that_sends_nothing_gets_no_rank(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 9)], "src long, dst long")
    tasks = {r.node: r.rank for r in rank.pagerank(edges, max_iter=5, tol=None).collect()}
    monkeypatch.setattr(rank, "TASK_EDGES", 0)
    rounds = {r.node: r.rank for r in rank.pagerank(edges, max_iter=5, tol=None).collect()}
    assert set(tasks) == {1, 2} and tasks == pytest.approx(rounds, abs=1e-14)
