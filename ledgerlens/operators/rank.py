"""PageRank E23 / E24 as an iterative join–aggregate.

Rank vectors never leave the cluster.  A graph that fits one task is iterated there,
all such graphs of a family side by side.  For larger ones the edge list is stored once, bucketed by
source node and a salt that spreads hot sources.  A node's row holds its ranks in
all graphs of the family (one for E23, one a lifetime month for E24) side by
side, and an edge says from which graph on it exists, so a growing graph costs
one edge list and one pass a round however many months it is looked at.

Per round a node sends its shares to its edge buckets, they are summed for each
destination with map-side partial sums, and the new row is written to the shared
checkpoint folder: a lost executor repeats at most that round.  A graph whose
ranks have settled is frozen and no longer computed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.functions import lifetime_month
from ledgerlens.operators.clock import both_orientations
from ledgerlens.operators.graph import graph_of, pair_first
from ledgerlens.schema import MAX_LIFETIME
from ledgerlens.session import checkpoint_dir, materialize, release, scratch_dir, shuffles_removed

# Defaults of the usual library implementation.
DAMPING = 0.85
MAX_ITER = 100
TOLERANCE = 1.0e-6
# The registered rank queries run at least so many rounds, and on until settled whatever the number of nodes.
SETTLED_ROUNDS = 20
#: edges of a graph that one task holds and iterates on its own (16 bytes each, some 60 with its working arrays)
TASK_EDGES = 4_000_000


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` once as a table bucketed by ``keys`` in the checkpoint folder.

    Reading it back, the planner knows the rows are hash-partitioned by
    ``keys``, so joins on them shuffle only the other side.  The write also
    cuts the lineage (a lost executor re-reads the table).
    """
    spark = df.sparkSession
    name = f"ledgerlens_bucketed_{uuid.uuid4().hex[:12]}"
    path = f"{scratch_dir(spark)}/{name}"
    # One write task per bucket, so each bucket is one file.
    with shuffles_removed(spark):
        (
            df.repartition(buckets, *keys)
            .write.mode("overwrite")
            .bucketBy(buckets, *keys)
            .option("path", path)
            .saveAsTable(name)
        )
    stored = spark.table(name)
    stored.__dict__.update(_ledgerlens_path=path, _ledgerlens_table=name)
    return stored


def _rank_task(alpha: float, max_iter: int, tol: float | None, settled: bool):
    """Rounds of whole graphs in one task: ``graph, src, dst`` in, a row per graph and node out.

    ``open`` says that the tolerance was not reached in ``max_iter`` rounds.
    """
    least = SETTLED_ROUNDS

    def one(graph: int, src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
        node, at = np.unique(src, return_inverse=True)
        n = len(node)
        out = np.bincount(at, minlength=n)
        to = np.minimum(np.searchsorted(node, dst), n - 1)
        known = node[to] == dst
        if not known.all():
            at, to = at[known], to[known]
        # edges in the order of their ends: sums are then made in memory order
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order]
        rank = np.full(n, 1.0 / n)
        left_open = tol is not None
        for done in range(1, max_iter + 1):
            new = (1.0 - alpha) / n + alpha * np.bincount(to, weights=(rank / out)[at], minlength=n)
            moved, rank = np.abs(new - rank).sum(), new
            if tol is not None and (done >= least and moved < tol if settled else moved < tol * n):
                left_open = False
                break
        return pa.RecordBatch.from_pydict(
            {"graph": np.full(n, graph, np.int32), "node": node, "rank": rank, "open": np.full(n, left_open)}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(c).to_numpy(zero_copy_only=False) for c in range(3)] for b in batches if b.num_rows]
        if not held:
            return
        graph, src, dst = (np.concatenate(part) for part in zip(*held))
        held.clear()
        for g in np.unique(graph):
            made = one(int(g), src[graph == g], dst[graph == g])
            for start in range(0, made.num_rows, 50_000):
                yield made.slice(start, 50_000)

    return run


def _ranked_in_tasks(edges: DataFrame, first: int, last: int, run) -> DataFrame:
    """Ranks of the graphs ``first`` to ``last``, each by one task of its own; stored, with ``open`` as ``_rank_task`` has it."""
    of = edges.where(F.col("first") <= last).select(
        F.explode(F.sequence(F.greatest("first", F.lit(first)).cast("int"), F.lit(last))).alias("graph"), "src", "dst"
    )
    dealt = of.repartitionById(last - first + 1, F.col("graph") - first)
    node = edges.schema["src"].dataType.simpleString()
    return materialize(dealt.mapInArrow(run, f"graph int, node {node}, rank double, open boolean"), "pagerank-graphs")


def pagerank_family(
    edges: DataFrame,
    graphs: int = 1,
    alpha: float = DAMPING,
    max_iter: int = MAX_ITER,
    tol: float | None = TOLERANCE,
    settled: bool = False,
    nodes: DataFrame | None = None,
) -> DataFrame:
    """Ranks of every node in a family of growing graphs, given as ``src, dst, first``.

    Graph ``m`` (0 to ``graphs - 1``) has the edges with ``first <= m``; each pair
    ``src, dst`` occurs once, and undirected graphs pass both orientations, so
    every node both sends and receives rank.  The result has a row ``graph, node, rank``
    per graph and node that sends in it.  The new rank is ``(1 - alpha) / N + alpha * sum``.

    With ``tol`` set, a graph is done once its L1 change is below ``tol * N`` with
    its own number of nodes N (the usual library's rule; two numbers a graph
    reach the driver), and one that is not done in ``max_iter`` rounds is an
    error; ``tol=None`` runs exactly ``max_iter`` rounds.  All ranks of a graph sum
    to 1, so the library's rule lets a large graph go after a few rounds (at a
    million nodes after the second).  With ``settled`` the L1 change itself must be below
    ``tol``, whatever N, after at least ``SETTLED_ROUNDS`` rounds; the change shrinks by
    ``alpha`` a round or faster, so that takes at most 90 rounds by default.

    A graph of at most ``TASK_EDGES`` edges is iterated by one task, the graphs of
    the family side by side: it fits that task's memory, and there a round takes less
    than the cluster needs to start one.  The larger graphs share the rounds of
    ``_ranked_in_rounds``.

    ``nodes`` (node, d0, …) are the stored out-degrees, counted here if not given.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    months = range(graphs)
    if nodes is None:
        degree = edges.groupBy(F.col("src").alias("node")).agg(*[F.count_if(F.col("first") <= m).alias(f"d{m}") for m in months])
        nodes = materialize(degree, "pagerank-degree")
    facts = nodes.agg(
        F.max(f"d{graphs - 1}").alias("most"),
        *[F.sum(f"d{m}").alias(f"w{m}") for m in months],
        *[F.count_if(F.col(f"d{m}") > 0).alias(f"n{m}") for m in months],
    ).first()
    size = {m: facts[f"n{m}"] for m in months if facts[f"n{m}"]}
    small = [m for m in size if facts[f"w{m}"] <= TASK_EDGES]
    large = [m for m in size if m not in small]
    made, left_open = [], False
    if small:
        ranked = _ranked_in_tasks(edges, small[0], small[-1], _rank_task(alpha, max_iter, tol, settled))
        left_open = not ranked.where("open").isEmpty()
        made.append(ranked.drop("open"))
    if large:
        edges_in = facts[f"w{large[-1]}"]
        ranked, unsettled = _ranked_in_rounds(edges, nodes, {m: size[m] for m in large}, edges_in, facts["most"], alpha, max_iter, tol, settled)
        left_open = left_open or unsettled
        slots = [F.struct(F.lit(m).alias("graph"), F.col(f"d{m}").alias("d"), F.col(f"r{m}").alias("rank")) for m in large]
        ranked = ranked.select("node", F.explode(F.array(*slots)).alias("k")).where(F.col("k.d") > 0)
        made.append(ranked.select("k.graph", "node", "k.rank"))
    # the last round is written, so nothing reads the degrees any more
    release(nodes)
    if left_open:
        raise RuntimeError(f"PageRank did not reach the tolerance {tol} in {max_iter} rounds")
    if not made:
        return edges.select(F.lit(0).alias("graph"), F.col("src").alias("node"), F.lit(0.0).alias("rank")).where(F.lit(False))
    return made[0] if len(made) == 1 else made[0].unionByName(made[1])


def _ranked_in_rounds(
    edges: DataFrame, nodes: DataFrame, size: dict[int, int], edges_in: int, most: int, alpha: float, max_iter: int,
    tol: float | None, settled: bool,
) -> tuple[DataFrame, bool]:
    """``node, d{m}, r{m}`` of the graphs ``m`` in ``size`` by join–aggregate rounds of the cluster, and whether one is still open.

    A node's row holds its ranks in all these graphs side by side (0 where it has no edge yet).

    Hot sources are salted: a source with more out-edges than an average
    bucket holds has its edges spread over ``s = ceil(out_deg / load)``
    buckets by a hash of the destination, and its shares are sent to each
    of those ``s`` buckets.  A hub holding a third of all edges therefore
    never makes one task process a third of the edges per round.
    """
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    months = list(size)
    degrees = [f"d{m}" for m in months]
    last = F.col(degrees[-1])
    load = max(1, -(-edges_in // buckets))
    state = nodes.where(last > 0).select(
        "node",
        F.least(F.ceil(last / F.lit(load)), F.lit(buckets)).cast("int").alias("s"),
        *degrees,
        *[F.when(F.col(f"d{m}") > 0, F.lit(1.0 / size[m])).otherwise(0.0).alias(f"r{m}") for m in months],
    )
    open_ = months
    slim = edges.select("src", "dst", "first")
    if most > load:
        slim = slim.join(state.select(F.col("node").alias("src"), "s"), "src")
        slim = slim.withColumn("salt", F.pmod(F.xxhash64("dst"), F.col("s")).cast("int")).drop("s")
    else:
        slim = slim.withColumn("salt", F.lit(0))
    stored = _bucketed(slim, ["src", "salt"], buckets)

    def step(now: DataFrame, change: Observation) -> DataFrame:
        # SQL text: a round has some hundred small expressions, and the driver builds them every time
        sent = now.where(" OR ".join(f"d{m} > 0" for m in open_)).selectExpr(
            "node AS src",
            # one copy of each row per salt bucket of its node (1 for all but hot sources)
            "explode(sequence(0, s - 1)) AS salt",
            *[f"try_divide(r{m}, d{m}) AS q{m}" for m in open_],
        )
        share = [F.expr(f"sum(CASE WHEN first <= {m} THEN q{m} END) AS t{m}") for m in open_]
        # edges outnumber nodes by far: they stream past a hash of the shares and are not sorted
        known = stored.where(f"first <= {open_[-1]}")
        sums = known.join(sent.hint("shuffle_hash"), ["src", "salt"]).groupBy("dst").agg(*share)
        new = {
            m: f"CASE WHEN d{m} > 0 THEN {(1.0 - alpha) / size[m]!r}D + {alpha!r}D * coalesce(t{m}, 0D) ELSE 0D END"
            for m in open_
        }
        made = now.join(sums, F.col("node") == F.col("dst"), "left").selectExpr(
            "node", "s", *degrees, *[f"r{m} AS old{m}" for m in open_], *[f"{new.get(m, f'r{m}')} AS r{m}" for m in months]
        )
        made = made.observe(change, *[F.expr(f"sum(abs(r{m} - old{m})) AS e{m}") for m in open_])
        return made.selectExpr("node", "s", *degrees, *[f"r{m}" for m in months])

    for done in range(1, max_iter + 1):
        # summed up by the tasks that write the new ranks
        change = Observation()
        new = materialize(step(state, change), "pagerank-ranks")
        release(state)
        state = new
        if tol is not None:
            moved = change.get
            if settled:
                open_ = [m for m in open_ if done < SETTLED_ROUNDS or moved[f"e{m}"] >= tol]
            else:
                open_ = [m for m in open_ if moved[f"e{m}"] >= tol * size[m]]
            if not open_:
                break
    # the last round is written, so nothing reads the edges any more
    release(stored)
    return state.select("node", *degrees, *[f"r{m}" for m in months]), tol is not None and bool(open_)


def pagerank(
    edges: DataFrame,
    alpha: float = DAMPING,
    max_iter: int = MAX_ITER,
    tol: float | None = TOLERANCE,
    settled: bool = False,
    nodes: DataFrame | None = None,
) -> DataFrame:
    """``node, rank`` of a graph given as distinct directed ``src, dst``; no edges give no ranks."""
    family = pagerank_family(edges.select("src", "dst", F.lit(0).alias("first")), 1, alpha, max_iter, tol, settled, nodes)
    return family.select("node", "rank")


def undirected_edges(payments: DataFrame) -> DataFrame:
    """Distinct ordered pairs of the loop-free symmetric log as ``src, dst``."""
    return pair_first(payments).select(F.col("user1").alias("src"), F.col("user2").alias("dst"))


def page_rank(
    payments: DataFrame, max_iter: int = MAX_ITER, tol: float | None = TOLERANCE, settled: bool = False
) -> DataFrame:
    """PageRank of every user on the whole-period undirected graph."""
    edges = undirected_edges(payments)
    nodes = graph_of(payments).degree.select(F.col("user1").alias("node"), F.col("num_friends").alias("d0"))
    return pagerank(edges, max_iter=max_iter, tol=tol, settled=settled, nodes=nodes).select(
        F.col("node").alias("user1"), F.col("rank").alias("PageRank")
    )


def monthly_edges(payments: DataFrame) -> DataFrame:
    """E24 graph family: every pair once in each orientation, with the ``first`` month that has it.

    A pair's month is taken on either end's clock, so the undirected edge exists
    from the smaller of the two on, which is the month on the clock of the end
    that started later.
    """
    g = graph_of(payments)
    starts = g.starts.select(F.col("user1").alias("_u"), F.col("start_date").alias("_s"))
    met = g.undirected
    for end in ("a", "b"):
        met = met.join(starts, F.col(end) == F.col("_u")).withColumnRenamed("_s", f"start_{end}").drop("_u")
    first = lifetime_month("datetime", F.greatest("start_a", "start_b"))
    met = met.select("a", "b", first.alias("first")).where(F.col("first") <= MAX_LIFETIME)
    return both_orientations(met, "a", "b", "first").select(
        F.col("user1").alias("src"), F.col("user2").alias("dst"), "first"
    )


def page_rank_by_month(
    payments: DataFrame, max_iter: int = MAX_ITER, tol: float | None = TOLERANCE, settled: bool = False
) -> DataFrame:
    """PageRank per lifetime month on the graph known by that month."""
    family = pagerank_family(monthly_edges(payments), MAX_LIFETIME + 1, max_iter=max_iter, tol=tol, settled=settled)
    return family.select(F.col("node").alias("user1"), F.col("graph").cast("bigint").alias("lifetime"), F.col("rank").alias("page_rank"))
