"""Hand-made graphs (FIXTURES.md §5)."""

import random

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from ledgerlens.operators import clock, features, graph, rank

A, B, C, D, H = 1, 2, 3, 4, 10


def test_triangle_closes_in_each_corners_month(make_payments):
    p = make_payments([(A, B, 0), (B, C, 10), (C, A, 40)])
    tri = graph.triangles(p).collect()
    assert len(tri) == 1
    assert (tri[0].user_a, tri[0].user_b, tri[0].user_c) == (A, B, C)
    months = as_dict(graph.triangle_month(p), ["user1"], "lifetime")
    # closes on day 40: month 2 for A and B (first day 0), month 1 for C (first day 10)
    assert months == {(A,): 2, (B,): 2, (C,): 1}
    new = as_dict(graph.new_triangles(p), ["user1", "lifetime"], "num_triangles")
    assert new == {(A, 2): 1.0, (B, 2): 1.0, (C, 1): 1.0}


def test_square_has_no_triangle_and_opposite_corner_two_hops(make_payments):
    p = make_payments([(A, B, 0), (B, C, 0), (C, D, 0), (D, A, 0)])
    assert graph.triangles(p).count() == 0
    cc = graph.clustering_coefficient(p).where("lifetime = 12").collect()
    assert all(r.cluster_coefficient == 0.0 for r in cc)
    only = graph.two_hop_only(p, drop_self=True).collect()
    assert sorted((r.user1, r.two_hop) for r in only) == [(A, C), (B, D), (C, A), (D, B)]
    # with the user itself kept (as in the source analysis)
    assert graph.two_hop_only(p).count() == 8


def test_star_hub_cc_zero_leaf_null(make_payments):
    p = make_payments([(H, i, 0) for i in (1, 2, 3, 4)])
    cc = as_dict(graph.clustering_coefficient(p).where("lifetime = 0"), ["user1"], "cluster_coefficient")
    assert cc[(H,)] == 0.0
    assert all(cc[(i,)] is None for i in (1, 2, 3, 4))


def test_mutual_payers_are_one_friend(make_payments):
    p = make_payments([(A, B, 0), (B, A, 5)])
    fr = as_dict(graph.cum_friends(p).where("lifetime = 12"), ["user1"], "cum_num_friends")
    assert fr == {(A,): 1, (B,): 1}
    assert graph.friend_list(p).count() == 2


def test_self_loop_dropped_in_graph_kept_in_counts(make_payments):
    p = make_payments([(A, A, 0), (A, B, 3)])
    assert sorted((r.user1, r.user2) for r in graph.friend_pairs(p).collect()) == [(A, B), (B, A)]
    y = as_dict(features.first_year_txn(p), ["user1"], "num_transaction")
    assert y == {(A,): 2}


def test_receive_only_user_in_graph_not_in_sender_tables(make_payments):
    p = make_payments([(A, B, 0)])
    spine_users = {r.user1 for r in graph.graph_spine(p).collect()}
    assert spine_users == {A, B}
    assert {r.user1 for r in features.first_year_txn(p).collect()} == {A}
    m3 = features.model3_input(p, rank.page_rank(p)).collect()
    assert {r.user1 for r in m3} == {A}


def test_month_boundaries(make_payments):
    p = make_payments([(A, B, d) for d in (0, 1, 30, 31, 360, 361)])
    rows = clock.sender_clock(p).collect()
    assert sorted((r.days, r.lifetime) for r in rows) == [
        (0, 0), (1, 1), (30, 1), (31, 2), (360, 12), (361, 13)
    ]


def test_recency_is_30_minus_x(make_payments):
    x = 12
    p = make_payments([(A, B, 0), (A, B, x)])
    rf = as_dict(features.rf_model(p), ["user1", "lifetime"], "recency")
    assert rf[(A, 1)] == 30 - x
    assert rf[(A, 0)] == 0


def test_fof_time_respecting_and_null_row(make_payments):
    # B-C happens after A-B: C is not reachable from A through B at A-B time.
    p = make_payments([(A, B, 0), (B, C, 10)])
    fof = {(r.user1, r.friend_of_friend): r.lifetime for r in graph.fof_first_met(p).collect()}
    assert (A, C) not in fof
    assert fof[(A, None)] == 0
    # C reaches A through B (C-B on day 10 is after A-B on day 0)
    assert fof[(C, A)] == 0


def test_pagerank_sums_to_one_and_is_symmetric_on_ring(make_payments):
    p = make_payments([(1, 2, 0), (2, 3, 0), (3, 4, 0), (4, 1, 0)])
    pr = rank.page_rank(p).collect()
    total = sum(r.PageRank for r in pr)
    assert abs(total - 1.0) < 1e-9
    assert all(abs(r.PageRank - 0.25) < 1e-9 for r in pr)


def test_pagerank_matches_power_iteration(make_payments):
    import numpy as np

    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (1, 6)]
    p = make_payments([(u, v, 0) for u, v in edges])
    pr = {r.user1: r.PageRank for r in rank.page_rank(p, max_iter=200, tol=1e-12).collect()}
    nodes = sorted(pr)
    idx = {n: i for i, n in enumerate(nodes)}
    adj = np.zeros((len(nodes), len(nodes)))
    for u, v in edges:
        adj[idx[u], idx[v]] = adj[idx[v], idx[u]] = 1
    m = adj / adj.sum(axis=1, keepdims=True)
    x = np.full(len(nodes), 1 / len(nodes))
    for _ in range(500):
        x = 0.85 * x @ m + 0.15 / len(nodes)
    for n in nodes:
        assert abs(pr[n] - x[idx[n]]) < 1e-9


def test_cumulative_profile_worked_example(spark, make_payments):
    from ledgerlens.operators import profile
    from ledgerlens.sources import fixture_dictionary

    # day 0: one food payment; by day 30: one more food and two activity
    p = make_payments([(A, B, 0, "🍕"), (A, B, 5, "hot"), (A, B, 10, "gizmo"), (A, B, 20, "gizmo")])
    cp = {r.lifetime: r for r in profile.cumulative_profile(p, fixture_dictionary(spark)).collect()}
    assert cp[0].Food == 1.0 and cp[0].Activity == 0.0
    assert cp[1].Food == 0.5 and cp[1].Activity == 0.5
    assert cp[12].Food == 0.5  # months without payments carry the shares


def test_pagerank_salted_hub_matches_power_iteration(make_payments):
    """A hub with more out-edges than a bucket's average load is salted
    (600 leaves vs 1400 edges over 4 buckets → its edges go to 2 buckets);
    ranks must still equal plain power iteration."""
    import numpy as np

    leaves = list(range(1, 601))
    edges = [(0, v) for v in leaves] + [(v, v + 1) for v in range(1, 101)]
    p = make_payments([(u, v, 0) for u, v in edges])
    pr = {r.user1: r.PageRank for r in rank.page_rank(p, max_iter=30, tol=None).collect()}
    nodes = sorted(pr)
    idx = {n: i for i, n in enumerate(nodes)}
    adj = np.zeros((len(nodes), len(nodes)))
    for u, v in edges:
        adj[idx[u], idx[v]] = adj[idx[v], idx[u]] = 1
    m = adj / adj.sum(axis=1, keepdims=True)
    x = np.full(len(nodes), 1 / len(nodes))
    for _ in range(30):
        x = 0.85 * x @ m + 0.15 / len(nodes)
    assert max(abs(pr[n] - x[idx[n]]) for n in nodes) < 1e-12


def test_fof_exclusion_modes(make_payments):
    # A–C on day 0 (direct friends in month 0); A–B and B–C on day 5, so A
    # reaches C through B in month 1.
    p = make_payments([(A, C, 0), (A, B, 5), (B, C, 5)])
    same = {(r.user1, r.friend_of_friend): r.lifetime for r in graph.fof_new(p).collect()}
    known = {(r.user1, r.friend_of_friend): r.lifetime for r in graph.fof_new(p, exclude="known_by_then").collect()}
    assert same[(A, C)] == 1  # direct friendship began in month 0, not month 1
    assert (A, C) not in known  # already a friend by month 1
    assert same[(A, None)] == 0 and known[(A, None)] == 0


def test_network_profile_sees_no_later_payment(spark, make_payments):
    """B pays for food on day 0 (its month 0) and for transport on day 45 (its month 2)."""
    from ledgerlens.sources import fixture_dictionary

    p = make_payments([(B, A, 0, "cold"), (B, C, 45, "rod")])
    rows = features.network_profile(p, fixture_dictionary(spark)).where("hop = 1")
    of_a = {r.lifetime: (r.n_contacts, r.Food, r.Transportation) for r in rows.where(f"user1 = {A}").collect()}
    assert of_a == {m: (1, 1.0, 0.0) if m < 2 else (1, 0.5, 0.5) for m in range(13)}


def test_network_profile_does_not_know_a_contact_who_pays_later(spark, make_payments):
    """A pays B on day 0; B pays nobody until day 270, which is A's month 9 (days 241 to 270)."""
    from ledgerlens.sources import fixture_dictionary

    p = make_payments([(A, B, 0, "cold"), (B, C, 270, "rod")])
    rows = features.network_profile(p, fixture_dictionary(spark)).where("hop = 1")
    of_a = {r.lifetime: (r.n_contacts, r.Transportation) for r in rows.where(f"user1 = {A}").collect()}
    assert of_a == {m: (1, 1.0) for m in range(9, 13)}
    # C starts on day 270 and knows B, whose first month is over that very day
    of_c = {r.lifetime: (r.n_contacts, r.Transportation) for r in rows.where(f"user1 = {C}").collect()}
    assert of_c == {m: (1, 1.0) for m in range(13)}


def test_network_profile_counts_months_of_both_clocks(spark, make_payments):
    """B is 40 days older than A: B's month 2 (days 31 to 60) ends 20 days into A's life, in A's month 1."""
    from ledgerlens.sources import fixture_dictionary

    p = make_payments([(B, C, 0, "cold"), (B, C, 55, "rod"), (A, B, 40, "bolt"), (B, C, 85, "anvil")])
    rows = features.network_profile(p, fixture_dictionary(spark)).where("hop = 1")
    of_a = {r.lifetime: (r.Food, r.Transportation, r.Illegal_Sarcasm) for r in rows.where(f"user1 = {A}").collect()}
    # as of day 40 only B's months 0 and 1 are over; from day 70 on month 2, from day 100 on month 3
    assert of_a[0] == (1.0, 0.0, 0.0)
    assert of_a[1] == (0.5, 0.5, 0.0)
    assert of_a[2] == pytest.approx((1 / 3, 1 / 3, 1 / 3)) and of_a[12] == of_a[2]


def test_hub_grid_changes_no_result(make_payments):
    """A hub with a third of the pairs, joined through in blocks of 7 neighbours."""
    rng = random.Random(11)
    hub = [(0, u, u % 50) for u in range(1, 80)]
    other = [(rng.randrange(1, 80), rng.randrange(1, 80), rng.randrange(200)) for _ in range(160)]
    p = make_payments([r for r in hub + other if r[0] != r[1]])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(graph.two_hop(p, hub_block=7)) == rows(graph.two_hop(p))
    small = graph.fof_first_met(p, keep_null=False, hub_block=7)
    assert rows(small) == rows(graph.fof_first_met(p, keep_null=False))


def test_hub_grid_bounds_every_key(make_payments):
    """No key of the join through a hub has more than about a block of rows on either side."""
    p = make_payments([(0, u, u % 30) for u in range(1, 2001)] + [(u, u + 1, 40) for u in range(1, 2000)])
    g = graph.graph_of(p)
    pairs = graph.friend_pairs(p)
    left = pairs.select("user1", F.col("user2").alias("via"))
    right = pairs.select(F.col("user1").alias("via"), F.col("user2").alias("far"))
    rows, cols = graph.hub_grid(left, right, g.degree, 100)
    for side in (rows, cols):
        assert side.groupBy("via", "_row", "_col").count().agg(F.max("count")).first()[0] < 200
    assert rows.where("via = 0").select("_row", "_col").distinct().count() == 400


def test_registered_ranks_settle_whatever_the_number_of_nodes(spark, make_payments, monkeypatch):
    """A path mixes slowly; the library's tolerance times nodes ends its ranks 100 times further from the settled ones."""
    import numpy as np

    from ledgerlens.plans import catalog, oracle

    n = 600
    p = make_payments([(i, i + 1, 0) for i in range(n - 1)])
    monkeypatch.setattr(catalog, "_p", lambda spark, d: p)
    adj = np.eye(n, k=1) + np.eye(n, k=-1)
    m = adj / adj.sum(axis=1, keepdims=True)
    x = np.full(n, 1 / n)
    for _ in range(300):
        x = 0.85 * x @ m + 0.15 / n
    settled = {r.user1: r.PageRank for r in catalog.q_pagerank(spark, "").collect()}
    assert sum(abs(settled[i] - x[i]) for i in range(n)) < 1e-5
    last = {r.user1: r.page_rank for r in catalog.q_pagerank_by_month(spark, "").where("lifetime = 12").collect()}
    assert sum(abs(last[i] - x[i]) for i in range(n)) < 1e-5
    for name in ("pagerank", "pagerank_by_month"):
        assert "* r.n" not in oracle.ORACLE[name]


def _largest_task(df):
    from pyspark.sql import functions as F

    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_a_join_through_users_is_divided_by_what_it_makes(make_payments):
    """The sides are a few hundred rows, which the planner would put into one task."""
    from pyspark.sql import functions as F

    p = make_payments([(u, (u + k) % 200, u % 50) for u in range(200) for k in range(1, 6)])
    g = graph.graph_of(p)
    left = g.pairs.select("user1", F.col("user2").alias("via"))
    right = g.pairs.select(F.col("user1").alias("via"), F.col("user2").alias("far"))
    plain = sorted(map(tuple, left.join(right, "via").select("user1", "via", "far").collect()))
    for block in (1000, 3):
        made = graph.join_via(left, right, g.degree, block, task_rows=500)
        assert sorted(map(tuple, made.select("user1", "via", "far").collect())) == plain
        assert len(plain) == 20000 and _largest_task(made) <= 2000


def test_contacts_steps_are_divided_and_a_wide_contact_is_dealt(spark, make_payments):
    from pyspark.sql import functions as F

    p = make_payments([(0, u, 0) for u in range(1, 301)] + [(u, u + 1, 1) for u in range(1, 100)])
    g = graph.graph_of(p)
    known = graph.two_hop(p).withColumnRenamed("two_hop", "contact").unionByName(g.pairs.select("user1", F.col("user2").alias("contact")))
    steps = spark.createDataFrame([(c, f"s{c}") for c in range(301)], "contact long, steps string")
    plain = sorted(map(tuple, known.join(steps, "contact").select("user1", "contact", "steps").collect()))
    made = features.with_steps(known, steps, g, task_rows=200)
    assert sorted(map(tuple, made.select("user1", "contact", "steps").collect())) == plain
    assert _largest_task(made) <= 1500 < len(plain) / 40


def test_wedges_stream_past_a_hash_of_the_edges(make_payments):
    """Wedges are many times the edges, so the join that closes triangles must not sort them."""
    p = make_payments([(a, b, a + b) for a in range(1, 7) for b in range(a + 1, 7)])
    tri = graph.triangles(p)
    assert len({(r.user_a, r.user_b, r.user_c) for r in tri.collect()}) == 20
    assert "ShuffledHashJoin [b" in tri._jdf.queryExecution().executedPlan().toString()


def test_pair_months_are_made_once(make_payments):
    """Reached and unreached contacts both start from the stored payments per pair and month."""
    p = make_payments([(A, B, 0), (B, C, 1), (C, D, 40), (A, B, 45)])
    fof = graph.fof_first_met(p)
    assert any("/pair-months-" in f for f in fof.inputFiles())
    got = {(r.user1, r.friend_of_friend): r.lifetime for r in fof.collect()}
    assert got == {(A, None): 0, (A, C): 2, (B, None): 0, (C, A): 0, (C, None): 2, (D, B): 0}
