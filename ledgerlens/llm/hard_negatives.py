"""Operator 13: hard negatives by rotated one-bit codes, exact after integer scoring.

A vector is rotated and coded by the signs of its components.  With the
unit code vector s, the stored alignment a = <v, s> splits it into v = a s + r,
r orthogonal to s, so that <q, v> = a <q, s> + <q, r>.  The first part comes from
popcounts of the code against the bit planes of the quantised query; the second
is at most |q| |r| by Cauchy-Schwarz.  That interval is certain, not probable.  The residual r is rotated and coded in
turn (``LEVELS`` codes in all), each code leaving about 0.6 of |r|; a row is looked
at level by level as long as its interval can still decide the answer.  Rows whose intervals survive
are scored by the exact integer product.

Anchors are a stated query set against all rows, in blocks: anchors and rows are
dealt to blocks of bounded size by a hash of a stored row number, whatever their
labels or values, and each pair of blocks is one group.  A group returns at most
a few rows an anchor, and Spark ranks those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import col, finite_vector, integer_components
from ledgerlens.session import materialize

#: codes a vector
LEVELS = 7
#: bits of a query component
QUERY_BITS = 8
#: rows and anchors of a block, about
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 1024
#: most shuffle partitions asked for; beyond it a task handles several pairs of blocks in turn
MAX_TASKS = 20_000
#: share of |q| |v| added to every interval for the rounding of its floating-point steps
ROUNDING = 1e-9
#: largest component: products of 64 of these still fit into a long
LIMIT = 1 << 27
SEED = 13

_SHIFTS = np.arange(QUERY_BITS, dtype=np.uint16)[:, None]
_NO_ID = np.iinfo(np.int64).max


def rotations(dim: int, seed: int = SEED, levels: int = LEVELS) -> list[np.ndarray]:
    """A random orthogonal matrix for each level."""
    if not dim:
        return [np.zeros((0, 0))] * levels
    rng = np.random.default_rng(seed)
    made = [np.linalg.qr(rng.normal(size=(dim, dim))) for _ in range(levels)]
    return [q * np.sign(np.diag(r)) for q, r in made]


def pack(bits: np.ndarray) -> np.ndarray:
    """Bits of the last axis as 64-bit words."""
    words = -(-bits.shape[-1] // 64)
    wide = np.zeros((*bits.shape[:-1], words * 64), np.uint8)
    wide[..., : bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1).view(np.uint64)


class Codes:
    """One-bit codes of a block's vectors, the alignment of each, and bounds of what it leaves."""

    def __init__(self, dim: int, bits: np.ndarray, reals: np.ndarray):
        self.dim, self.levels = dim, bits.shape[1]
        self.bits = [np.ascontiguousarray(bits[:, level]) for level in range(self.levels)]
        norm, align, left = reals[:, 0], reals[:, 1 : 1 + self.levels], reals[:, 1 + self.levels :]
        root = np.sqrt(max(dim, 1))
        self.align = [align[:, level] / root for level in range(self.levels)]
        ones = [np.bitwise_count(b).sum(1).astype(np.int64) for b in self.bits]
        #: ones less zeros of a code, times its alignment
        self.signs = [(2 * n - dim) * a for n, a in zip(ones, self.align)]
        #: what a unit of the query's quantising loss, and a unit of its norm, add to the interval
        self.spread = list(np.cumsum(align, axis=1).T.copy())
        self.left = [left[:, level] + ROUNDING * norm for level in range(self.levels)]

    @staticmethod
    def of(x: np.ndarray, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What is stored of each vector: the bits of its codes, and norm, alignments and norms left."""
        root = np.sqrt(max(x.shape[1], 1))
        bits, align, left, rest = [], [], [], x
        for turn in turns:
            rest = rest @ turn
            sign = rest >= 0
            along = np.abs(rest).sum(1) / root
            rest = rest - np.where(sign, 1.0, -1.0) * (along / root)[:, None]
            bits.append(pack(sign))
            align.append(along)
            left.append(np.linalg.norm(rest, axis=1))
        return np.stack(bits, axis=1), np.stack([np.linalg.norm(x, axis=1), *align, *left], axis=1)


class Queries:
    """Anchors turned for every level, their components quantised and laid out as bit planes."""

    def __init__(self, q: np.ndarray, turns: list[np.ndarray]):
        self.norm = np.linalg.norm(q, axis=1)
        self.low, self.step, self.total, self.planes = [], [], [], []
        self.lost = np.zeros(len(q))
        top = (1 << QUERY_BITS) - 1
        for turn in turns:
            q = q @ turn
            low = q.min(axis=1, initial=0.0)
            step = np.maximum((q.max(axis=1, initial=0.0) - low) / top, 1e-300)
            units = np.clip(np.rint((q - low[:, None]) / step[:, None]), 0, top).astype(np.int64)
            self.low.append(low)
            self.step.append(step)
            self.total.append(units.sum(1))
            self.planes.append(pack((units[:, None, :] >> np.arange(QUERY_BITS)[:, None]) & 1))
            # what quantising lost, as a length
            left = np.linalg.norm(q - (low[:, None] + step[:, None] * units), axis=1)
            self.lost = np.maximum(self.lost, left)

    def along(self, i: int, codes: Codes, level: int, rows) -> np.ndarray:
        """Alignment times the product of quantised anchor ``i`` with the unit code vectors, by popcounts."""
        planes, bits = self.planes[level][i], codes.bits[level][rows]
        weighted = np.zeros(len(bits), np.int64)
        for word in range(bits.shape[1]):
            both = np.bitwise_count(planes[:, word, None] & bits[None, :, word])
            # at most 64 * 255, so 16 bits hold the sum
            weighted += (both.astype(np.uint16) << _SHIFTS).sum(0, dtype=np.uint16)
        low, step = self.low[level][i], self.step[level][i]
        return codes.signs[level][rows] * low + codes.align[level][rows] * (2 * step * weighted - step * self.total[level][i])


def survivors(queries: Queries, i: int, codes: Codes, block: slice, narrow) -> np.ndarray:
    """Rows of a part of the block whose score with anchor ``i`` may matter.

    ``narrow(rows, low, high)`` says for certain intervals which rows may still
    decide the answer; it is asked again after every level.
    """
    rows, at = np.arange(block.start, block.stop), block
    part = np.zeros(len(rows))
    for level in range(codes.levels):
        if not len(rows):
            break
        part = part + queries.along(i, codes, level, at)
        wide = queries.lost[i] * codes.spread[level][at] + queries.norm[i] * codes.left[level][at]
        keep = narrow(rows, part - wide, part + wide)
        if not keep.all():
            rows, part = rows[keep], part[keep]
            at = rows
    return rows


def at_least(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the ``k`` highest: no k others are certainly higher."""
    if len(low) <= k:
        return np.ones(len(low), bool)
    return high >= np.partition(low, len(low) - k)[len(low) - k]


def in_bands(low: np.ndarray, high: np.ndarray, bands: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the ``k`` highest inside one of the bands."""
    keep = (high >= bands[:, 0].min()) & (low <= bands[:, 1].max())
    near = np.flatnonzero(keep)
    low, high = low[near], high[near]
    if (high - low).min(initial=np.inf) > (bands[:, 1] - bands[:, 0]).max():
        return keep  # no interval lies inside a band, so none is certain
    keep[:] = False
    for bottom, top in bands:
        may = (high >= bottom) & (low <= top)
        sure = low[(low >= bottom) & (high <= top)]
        if len(sure) >= k:
            may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
        keep[near[may]] = True
    return keep


def bands(positive_scores: np.ndarray, share: tuple[int, int] = (50, 95)) -> np.ndarray:
    """Lowest and highest integer score that a negative of each positive may have, without overflow."""
    p = np.asarray(positive_scores, np.int64)
    least = -((-p // 100) * share[0] + ((-p % 100) * share[0]) // 100)
    most = (p // 100) * share[1] + ((p % 100) * share[1]) // 100
    return np.stack([least, most], axis=1)


class Block:
    """Rows of a block with their codes, ordered by label."""

    def __init__(self, frame: pd.DataFrame):
        frame = frame.sort_values("label", kind="stable")
        n, dim = len(frame), int(frame["dim"].iloc[0])
        self.x = np.frombuffer(b"".join(frame["x"]), np.int64).reshape(n, dim)
        self.row = frame["row"].to_numpy(np.int64)
        # a null id comes after every other
        self.id = frame["vec_id"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
        self.label = frame["label"].to_numpy(np.int64)
        words = -(-dim // 64)
        bits = np.frombuffer(b"".join(frame["bits"]), np.uint64).reshape(n, LEVELS, words)
        reals = np.frombuffer(b"".join(frame["reals"]), float).reshape(n, 1 + 2 * LEVELS)
        self.codes = Codes(dim, bits, reals)
        self.float = self.x.astype(float) if np.abs(self.x).max(initial=0) < 1 << 22 else None
        self.scored = 0

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right")))

    def score(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        self.scored += len(rows)
        if self.float is not None and np.abs(q).max(initial=0) < 1 << 22:  # every step is an exact integer
            return (self.float[rows] @ q.astype(float)).astype(np.int64)
        return self.x[rows] @ q

    def first(self, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places of the first ``k``: higher scores, then smaller ids."""
        if len(score) > k:
            at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        else:
            at = np.arange(len(score))
        return at[np.lexsort((self.row[rows[at]], self.id[rows[at]], -score[at]))][:k]

    def positives(self, q: np.ndarray, queries: Queries, i: int, anchor_row: int, label: int, k: int):
        """The first ``k`` other rows of the anchor's label."""

        def narrow(rows, low, high):
            other = self.row[rows] != anchor_row
            keep = other.copy()
            keep[other] = at_least(low[other], high[other], k)
            return keep

        rows = survivors(queries, i, self.codes, self.of_label(label), narrow)
        score = self.score(q, rows)
        at = self.first(rows, score, k)
        return rows[at], score[at]

    def negatives(self, q: np.ndarray, queries: Queries, i: int, label: int, limits: np.ndarray, k: int):
        """For each band the first ``k`` rows of another label inside it."""
        own = self.of_label(label)
        for part in (slice(0, own.start), slice(own.stop, len(self.row))):
            rows = survivors(queries, i, self.codes, part, lambda _, low, high: in_bands(low, high, limits, k))
            score = self.score(q, rows)
            for n, (bottom, top) in enumerate(limits):
                inside = np.flatnonzero((score >= bottom) & (score <= top))
                at = inside[self.first(rows[inside], score[inside], k)]
                if len(at):
                    yield n, rows[at], score[at]


def _ids(found: np.ndarray) -> pd.Series:
    ids = pd.Series(found, dtype="Int64")
    return ids.mask(ids == _NO_ID)


def _columns(parts: list[tuple], n: int) -> list[np.ndarray]:
    """Rows given in parts, as whole columns; a number stands for all rows of its part."""
    if not parts:
        return [np.zeros(0, np.int64)] * n
    return [np.concatenate([np.broadcast_to(p[i], len(p[-1])) for p in parts]) for i in range(n)]


def coded_rows(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, flip_every: int | None, n_labels: int
) -> DataFrame:
    """The integer vectors that take part, numbered and stored with their codes and alignments."""
    label = col(label_col).cast("long")
    if flip_every:
        changed = F.coalesce(col(id_col) % flip_every == 0, F.lit(False))
        label = F.when(changed, (label + 1) % n_labels).otherwise(label)
    slim = df.where(col(label_col).isNotNull() & finite_vector(vector_col)).select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).cast("long").alias("vec_id"),
        label.alias("label"),
        F.size(col(vector_col)).alias("dim"),
        integer_components(vector_col).alias("v"),
    )

    def run(frames):
        for frame in frames:
            vectors = frame.pop("v")
            for dim, at in frame.groupby("dim").indices.items():
                x = np.array([vectors.iloc[i] for i in at], np.int64).reshape(len(at), int(dim))
                if np.abs(x).max(initial=0) > LIMIT:
                    raise ValueError(f"a component beyond {LIMIT // 256} has products that no long can hold")
                bits, reals = Codes.of(x.astype(float), rotations(int(dim)))
                part = frame.iloc[at].astype({"vec_id": "Int64"})
                yield part.assign(
                    x=[v.tobytes() for v in x], bits=[v.tobytes() for v in bits], reals=[v.tobytes() for v in reals]
                )

    made = slim.mapInPandas(run, "row long, vec_id long, label long, dim int, x binary, bits binary, reals binary")
    return materialize(made, "negative-rows")


def mine(
    df: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    anchor_every: int = 50,
    flip_every: int | None = 7,
    n_labels: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Hard negatives of every anchor and positive, exactly.

    Anchors are the rows whose id is divisible by ``anchor_every``.  Rows with a
    null label, a null vector, or a null or non-finite component take no part.
    A row with a null id is no anchor and comes after other ids in a tie.
    Repeated rows are rows of their own: a copy of an anchor is another anchor
    and one of its positives, and its results are repeated.  Vectors of
    different lengths have no product, so rows meet only rows of their own
    length.  An anchor without positives, and a positive without negatives in
    its band, have no rows; an empty table gives none.  Other columns are not
    looked at.  Components beyond 2**19 are an error, since their products do
    not fit into a long.
    """
    rows = coded_rows(df, id_col, vector_col, label_col, flip_every, n_labels)
    is_anchor = F.coalesce(F.col("vec_id") % anchor_every == 0, F.lit(False))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).first()
    n_rows, n_anchors = (max(1, -(-n // size)) for n, size in ((counts["n"], block_rows), (counts["a"], block_anchors)))

    def dealt(parts: int, seed: int) -> F.Column:
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int")

    def every(parts: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    anchors = rows.where(is_anchor).drop("bits", "reals").withColumn("a", dealt(n_anchors, SEED))
    right = rows.withColumn("b", dealt(n_rows, SEED + 1)).withColumn("a", every(n_anchors))

    # several partitions for each pair of blocks, so that pairs seldom share a task
    tasks, key = min(4 * n_rows * n_anchors, MAX_TASKS), ["dim", "a", "b"]
    right = right.repartition(tasks, *key)

    def blocks(left: DataFrame, task, schema: str) -> DataFrame:
        left = left.withColumn("b", every(n_rows)).repartition(tasks, *key)
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(task, schema)

    def near(asking: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, anchor, q, queries, block in _each(asking, asked):
            at, score = block.positives(q, queries, i, anchor.row, anchor.label, positives)
            out.append((anchor.row, block.row[at], block.id[at], score))
        anchor_row, row, ids, score = _columns(out, 4)
        return pd.DataFrame({"anchor_row": anchor_row, "positive_row": row, "positive_id": _ids(ids), "positive_score": score})

    found = blocks(anchors, near, "anchor_row long, positive_row long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row")
    # at most ``positives`` rows an anchor are left when the scores are gathered
    pos = (
        found.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= positives)
        .groupBy("anchor_row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("pos"))
    )
    paired = anchors.join(pos, anchors["row"] == pos["anchor_row"]).drop("anchor_row")
    paired = materialize(paired.withColumn("scores", F.col("pos.positive_score")), "negative-positives")

    def hard(asking: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, anchor, q, queries, block in _each(asking, asked):
            for n, at, score in block.negatives(q, queries, i, anchor.label, bands(anchor.scores), negatives):
                out.append((anchor.row, n + 1, block.row[at], block.id[at], score))
        anchor_row, place, row, ids, score = _columns(out, 5)
        return pd.DataFrame(
            {"anchor_row": anchor_row, "place": place, "negative_row": row, "negative_id": _ids(ids), "negative_score": score}
        )

    # the lists of positives stay behind; only their scores travel with the anchors
    slim = paired.select("row", "vec_id", "label", "dim", "x", "a", "scores")
    negs = blocks(slim, hard, "anchor_row long, place int, negative_row long, negative_id long, negative_score long")
    rank = Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row")
    negs = negs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
    facts = paired.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), F.explode("pos").alias("p")).select(
        "anchor_row", "anchor_id", "p.*"
    )
    return facts.join(negs, ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def _each(anchors: pd.DataFrame, frame: pd.DataFrame):
    """Anchors of one pair of blocks, each with its number, its vector, all bit planes and the coded rows."""
    if anchors.empty or frame.empty:
        return
    block, dim = Block(frame), int(anchors["dim"].iloc[0])
    x = np.frombuffer(b"".join(anchors["x"]), np.int64).reshape(len(anchors), dim)
    queries = Queries(x.astype(float), rotations(dim))
    for i, anchor in enumerate(anchors.itertuples(index=False)):
        yield i, anchor, x[i], queries, block


#: The definition for DuckDB: every anchor against every row.
SQL = """WITH part AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, len(embedding) AS dim,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
scored AS MATERIALIZED (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label = o.label AS same, o.rid, o.vec_id,
         CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM part a JOIN part o ON a.dim = o.dim AND a.rid <> o.rid
  WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, rid) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.rid) AS rank
  FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3"""
