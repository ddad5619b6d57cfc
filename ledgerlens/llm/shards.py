"""Operator 10: a uniform shuffle into shards of exact sizes.

Rows are first stored with a number each, so that recomputed tasks see the
same rows.  They fall into source partitions by a hash of that number.  A
communication matrix, drawn by exact multivariate hypergeometric draws, says
how many rows each partition sends to each shard; partitions permute locally
and cut their order by their row of the matrix.  After the exchange a shard's
rows are spread over cells by a second hash and permuted within each cell;
cells in order make up a uniform permutation, because spreading rows
independently and ordering each cell at random is one.  No window ever holds
more than a partition or a cell.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import col
from ledgerlens.session import materialize

#: rows of a source partition or of a cell, about
CELL_ROWS = 20_000


def shard_sizes(n: int, shards: int) -> np.ndarray:
    """Counts at most one apart."""
    return np.full(shards, n // shards) + (np.arange(shards) < n % shards)


def communication(rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard, as in a uniform permutation.

    A partition's row is a multivariate hypergeometric draw from the places
    that the shards still have.
    """
    rng = np.random.default_rng(seed)
    left, out = sizes.astype(np.int64).copy(), []
    for n in rows:
        if left.sum() < 1_000_000_000:  # as far as numpy draws whole rows
            draw = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        else:
            draw, need = np.zeros_like(left), int(n)
            for s, have in enumerate(left):
                draw[s] = _from_large_urn(rng, int(have), int(left[s + 1 :].sum()), need)
                need -= int(draw[s])
        left = left - draw
        out.append(draw)
    return np.array(out, np.int64).reshape(len(rows), len(sizes))


def _from_large_urn(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """Exact hypergeometric draw of few from many: a binomial proposal, thinned by the chance of no repeats."""
    if take == 0 or good == 0 or bad == 0:
        return take if bad == 0 else 0

    def distinct(n: int, x: int) -> float:
        return float(np.log1p(-np.arange(x) / n).sum()) if x <= n else -np.inf

    while True:
        x = int(rng.binomial(take, good / (good + bad)))
        if np.log(rng.random()) <= distinct(good, x) + distinct(bad, take - x):
            return x


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 11, cell_rows: int = CELL_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard).

    Law `rows`: shard counts differ by one at most.  Rows need no key: nulls,
    ties and repeated rows are told apart by their stored number, and each gets
    a place of its own.  An empty table gives an empty result; columns of the
    input named ``shard`` or ``slot`` are replaced.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    stored = materialize(df.select(*[col(c) for c in names], F.monotonically_increasing_id().alias("__llm_row")), "shards")
    total = stored.count()
    parts = max(1, -(-total // cell_rows))
    dealt = stored.withColumn("__llm_part", F.pmod(F.xxhash64("__llm_row", F.lit(seed)), F.lit(parts)).cast("int"))
    # one row per partition; partitions grow with the rows, at cell_rows each
    have = np.zeros(parts, np.int64)
    for p, n in dealt.groupBy("__llm_part").count().collect():
        have[p] = n
    matrix = communication(have, shard_sizes(total, shards), seed)
    ends = df.sparkSession.createDataFrame(
        [(p, [int(x) for x in np.cumsum(row)]) for p, row in enumerate(matrix)], "__llm_part int, __llm_ends array<long>"
    )
    local = Window.partitionBy("__llm_part").orderBy(F.xxhash64("__llm_row", F.lit(seed + 1)), "__llm_row")
    placed = dealt.withColumn("__llm_at", F.row_number().over(local) - 1)
    # the matrix has 16 numbers for every cell_rows rows
    placed = placed.join(ends, "__llm_part").withColumn(
        "shard", F.size(F.filter("__llm_ends", lambda e: e <= F.col("__llm_at")))
    )
    cells = max(1, -(-total // (shards * cell_rows)))
    sent = placed.select(
        *[col(c) for c in names],
        "shard",
        "__llm_row",
        F.pmod(F.xxhash64("__llm_row", F.lit(seed + 2)), F.lit(cells)).cast("int").alias("__llm_cell"),
    )
    again = Window.partitionBy("shard", "__llm_cell").orderBy(F.xxhash64("__llm_row", F.lit(seed + 3)), "__llm_row")
    sent = sent.withColumn("__llm_in", F.row_number().over(again) - 1)
    before = Window.partitionBy("shard").orderBy("__llm_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sent.groupBy("shard", "__llm_cell")
        .agg(F.count(F.lit(1)).alias("__llm_n"))
        .select("shard", "__llm_cell", F.coalesce(F.sum("__llm_n").over(before), F.lit(0)).alias("__llm_start"))
    )
    return sent.join(starts, ["shard", "__llm_cell"]).select(
        *[col(c) for c in names], "shard", (F.col("__llm_start") + F.col("__llm_in")).cast("long").alias("slot")
    )
