"""Operator 11: a mix of sources at target weights by a multivariate-hypergeometric splitting tree.

Each source's documents stand in a line, in an order given by hashes of their
keys.  The mix takes the whole line as often as the target holds it, and then
the front of it; the drawn documents of a source, numbered without gaps, make
blocks of ``BLOCK_DOCS``.  How many blocks of which source an output shard gets
is decided from the root of a binary tree downwards: a node's quota of every
source is split between its halves by one multivariate hypergeometric draw, so
that the leaves hold exact quotas and are distributed as if all blocks had been
shuffled.  A node's draw depends only on the seed and the node, so tasks expand
the part of the tree above their own leaves and the driver holds one number a
source.  A shard then takes the next so many blocks of each source from a
permutation of its block numbers, and shuffles its documents locally.

No task sees more than a cell of the line (about ``CELL_DOCS`` rows) or a shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import col
from ledgerlens.session import materialize

#: documents of a block, blocks of an output shard, documents of a cell of the line (about)
BLOCK_DOCS, SHARD_BLOCKS, CELL_DOCS = 64, 64, 20_000
#: sources that a mix may have, since their weights and sizes pass through the driver; more are an error
MAX_SOURCES = 1_000_000
#: sources whose facts are broadcast (some 100 bytes each); more are joined
BROADCAST_SOURCES = 10_000
#: blocks that one draw can split
MAX_BLOCKS = 999_999_999

WORD = r"[^\x20\x09-\x0D]+"
_OWN = ("source_size", "target", "copy", "shard", "slot")


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: int = 2) -> list[float]:
    """Words that each source gives: its weight's part of ``share`` times all words, at most ``most`` times its own.

    What a full source cannot take is shared anew by weight among the others.
    """
    out, left, rest = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while left:
        whole = sum(weights[i] for i in left)
        full = [i for i in left if rest * weights[i] / whole > most * sizes[i]]
        if not full:
            for i in left:
                out[i] = rest * weights[i] / whole
            break
        for i in full:
            out[i] = float(most * sizes[i])
            rest -= out[i]
        left = [i for i in left if i not in set(full)]
    return out


def capacity(blocks: int, shards: int, first: int, end: int) -> int:
    """Blocks that shards ``first`` to ``end`` (exclusive) hold; counts differ by one at most."""
    each, over = divmod(blocks, shards)
    return each * (end - first) + max(0, min(end, over) - min(first, over))


def split(
    quota: np.ndarray, shards: int, seed: int, wanted: tuple[int, int] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shard, blocks of each source, and blocks that earlier shards got, for the wanted leaves of the tree."""
    total = int(quota.sum())
    low, high = wanted or (0, shards)
    open_ = [(0, shards, quota.astype(np.int64), np.zeros(len(quota), np.int64))]
    while open_:
        first, end, have, before = open_.pop()
        if end <= low or first >= high:
            continue
        if end - first == 1:
            yield first, have, before
            continue
        mid = (first + end) // 2
        rng = np.random.default_rng([seed, first, end])
        left = rng.multivariate_hypergeometric(have, capacity(total, shards, first, mid), method="marginals")
        open_.append((mid, end, have - left, before + left))
        open_.append((first, mid, left, before))


def quotas(df: DataFrame, quota: list[int], shard_blocks: int, seed: int) -> DataFrame:
    """``rank, at, shard``: the shard of every place in the permuted block numbers of a source."""
    spark, total, sources = df.sparkSession, sum(quota), np.array(quota, np.int64)
    shards = max(1, -(-total // shard_blocks))

    def run(frames):
        for frame in frames:
            ids = frame["id"].to_numpy()
            # a range's rows follow each other, so one walk serves a whole batch
            for shard, have, before in split(sources, shards, seed, (int(ids.min()), int(ids.max()) + 1)):
                some = np.flatnonzero(have)
                yield pd.DataFrame({"shard": shard, "rank": some, "first": before[some], "n": have[some]})

    leaves = spark.range(shards).mapInPandas(run, "shard int, rank int, first long, n long")
    return leaves.select("rank", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("at"), "shard")


def _fill(size: np.ndarray, gap: float) -> np.ndarray:
    """Rows of the cell in which a source's target ends, in the order in which they are taken.

    The front as far as it fits, then each further document that still fits, then
    the one that comes nearest if that halves what is missing or better.
    """
    front = int((np.cumsum(size) <= gap).sum())
    taken, gap = list(range(front)), gap - float(size[:front].sum())
    for i in range(front, len(size)):
        if 0 < size[i] <= gap:
            taken.append(i)
            gap -= float(size[i])
    others = np.setdiff1d(np.flatnonzero(size > 0), taken)
    if gap > 0 and len(others):
        best = others[np.argmin(np.abs(size[others] - gap))]
        if size[best] - gap < gap:
            taken.append(int(best))
    return np.array(taken, np.int64)


def _place(frame: pd.DataFrame) -> pd.DataFrame:
    """Drawn copies of a cell's documents with their numbers among all that their source gives."""
    frame = frame.sort_values(["order", "row"], kind="stable")
    facts = frame.iloc[0]
    row, size, n = frame["row"].to_numpy(), frame["size"].to_numpy(), len(frame)
    docs, full, rest = int(facts["docs"]), int(facts["full"]), float(facts["rest"])
    begin, words = int(facts["docs_before"]), int(facts["words_before"])
    parts = [(row, np.arange(n) + begin + k * docs, k) for k in range(full)]
    if rest > 0 and words + int(size.sum()) <= rest:
        parts.append((row, np.arange(n) + begin + full * docs, full))
    elif rest > 0 and words <= rest:
        at = _fill(size, rest - words)
        parts.append((row[at], np.arange(len(at)) + begin + full * docs, full))
    parts = [p for p in parts if len(p[0])]
    if not parts:
        return pd.DataFrame(columns=["row", "rank", "number", "copy"])
    return pd.concat(
        [pd.DataFrame({"row": r, "rank": facts["rank"], "number": number, "copy": k}) for r, number, k in parts]
    )


def mix(
    df: DataFrame,
    size: Column,
    source: Column,
    key: Column,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block_docs: int = BLOCK_DOCS,
    shard_blocks: int = SHARD_BLOCKS,
    cell_docs: int = CELL_DOCS,
    seed: int = 23,
) -> DataFrame:
    """Rows of ``df`` once for every time the mix takes them, with ``source_size``, ``target``, ``copy``, ``shard``, ``slot``.

    ``size``, ``source`` and ``key`` are expressions over ``df``; the key decides
    the order of a source's documents, so that reruns agree however the table is
    split.  Rows that the mix does not take are returned once, with null ``copy``,
    ``shard`` and ``slot``.  Sources in code point order, null last, get the
    weights in turn.  A null size counts as 0; a source without words gives
    nothing.  Rows with equal keys are told apart by their stored number only,
    and a key that many rows share is spread over cells.  Documents of size 0
    are taken with the others around them.  An empty table gives no rows.
    Columns of ``df`` with the names of the added ones are replaced.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c not in _OWN]
    stored = materialize(
        df.select(
            *[col(c) for c in names],
            F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("__llm_size"),
            source.cast("string").alias("__llm_source"),
            key.cast("long").alias("__llm_key"),
            F.monotonically_increasing_id().alias("__llm_row"),
        ),
        "mixing",
    )
    slim = stored.select(
        F.col("__llm_row").alias("row"),
        F.col("__llm_size").alias("size"),
        F.col("__llm_source").alias("source"),
        F.col("__llm_key").alias("key"),
    )
    found = slim.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    found = found.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["words"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    facts = []
    for rank, (r, t) in enumerate(zip(found, goal)):
        full = min(int(t // r["words"]), most) if r["words"] else 0
        rest = max(0.0, t - full * r["words"])
        facts.append((r["source"], rank, r["words"], t, r["docs"], full, rest, -(-r["docs"] // cell_docs)))
    about = spark.createDataFrame(
        facts, "source string, rank int, words long, target double, docs long, full int, rest double, cells int"
    )
    about = F.broadcast(about) if len(facts) <= BROADCAST_SOURCES else about
    line = slim.join(about.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
    line = line.withColumn("cell", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("cells")).cast("int"))
    # rows with equal keys meet in a cell; one that overflows is divided by row number
    parts = line.groupBy("rank", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cell_docs)).alias("parts"))
    line = line.join(parts, ["rank", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("row", F.lit(seed)), F.col("parts")).cast("int")
    )
    before = Window.partitionBy("rank").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        line.groupBy("rank", "cell", "part")
        .agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"))
        .select(
            "rank",
            "cell",
            "part",
            F.coalesce(F.sum("w").over(before), F.lit(0)).alias("words_before"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        )
    )
    cells = line.join(starts, ["rank", "cell", "part"]).select(
        "rank", "cell", "part", "row", "size", "docs", "full", "rest", "words_before", "docs_before",
        F.xxhash64("key", F.lit(seed + 1)).alias("order"),
    )
    drawn = materialize(
        cells.groupBy("rank", "cell", "part").applyInPandas(_place, "row long, rank int, number long, copy int"), "mixing-drawn"
    )
    ends = {r["rank"]: r["n"] for r in drawn.groupBy("rank").agg((F.max("number") + 1).alias("n")).collect()}
    quota = [-(-ends.get(rank, 0) // block_docs) for rank in range(len(facts))]
    if sum(quota) > MAX_BLOCKS:
        raise ValueError(f"more than {MAX_BLOCKS} blocks; raise block_docs")
    turn = spark.createDataFrame(
        [(rank, max(q, 1), *_permutation(q, seed + rank)) for rank, q in enumerate(quota)], "rank int, q long, times long, plus long"
    )
    turn = F.broadcast(turn) if len(facts) <= BROADCAST_SOURCES else turn
    block = F.floor(F.col("number") / block_docs)
    dealt = drawn.join(turn, "rank").select("row", "copy", "rank", ((block * F.col("times") + F.col("plus")) % F.col("q")).alias("at"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64("row", "copy", F.lit(seed + 2)), "row", "copy")
    dealt = dealt.join(quotas(stored, quota, shard_blocks, seed), ["rank", "at"]).select(
        F.col("row").alias("__llm_row"), "copy", "shard", (F.row_number().over(local) - 1).cast("long").alias("slot")
    )
    known = about.select(F.col("source").alias("__llm_of"), F.col("words").alias("source_size"), "target")
    return (
        stored.join(dealt, "__llm_row", "left")
        .join(known, F.col("__llm_source").eqNullSafe(F.col("__llm_of")))
        .select(*[col(c) for c in names], *_OWN)
    )


def _permutation(n: int, seed: int) -> tuple[int, int]:
    """Factor and summand of a permutation of 0 to n-1."""
    rng = np.random.default_rng(seed)
    while n > 1:
        times = int(rng.integers(1, n))
        if gcd(times, n) == 1:
            return times, int(rng.integers(0, n))
    return 1, 0


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """A mix of documents by words: a document's size is its number of words (null text: 0)."""
    text = col(text_col).cast("string")
    return mix(df, F.regexp_count(text, F.lit(WORD)), col(source_col), F.xxhash64(col(id_col), text), **options)


def taken(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """For every document, the words that the mix takes of it, repeats counted."""
    text = col(text_col).cast("string")
    # sizes and hashes are taken first, so that no text is stored or shuffled
    slim = df.select(
        col(id_col).alias("doc_id"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        col(source_col).alias("source"),
        F.xxhash64(col(id_col), text).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    mixed = mix(slim, F.col("size"), F.col("source"), F.col("key"), **options)
    return (
        mixed.groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(F.count("copy").alias("copies"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )
