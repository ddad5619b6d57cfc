"""Operator 12: centroid clustering in exact integers, pruned by Ptolemaic pivot bounds.

Four points of Euclidean space obey Ptolemy's inequality, so for a vector x, a
centroid c and two pivots p, s

    d(x, c) * d(p, s)  >=  | d(x, p) * d(c, s) - d(x, s) * d(c, p) |.

The pivots and their pairs are fixed for the whole run and each vector's
distances to the pivots are computed once and stored beside it.  In a round only
the few distances between centroids and pivots are new; they give every
(vector, centroid) pair a lower bound.  A vector looks at centroids in the order
of their bounds and stops where the bound, rounded downwards, exceeds the
smallest exact distance so far.  Distances and sums are integers, so neither the
pivots nor the partitioning can change a result.

Tasks see slices of stored vectors and emit at most one row of sums for each
centroid; only the centroids (k rows) and the pivots reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import col, finite_vector, integer_components
from ledgerlens.session import materialize

#: vectors (about) on which the pivots are fitted; they steer pruning only
PIVOT_SAMPLE = 20_000
#: rows whose bounds are held at once in a task
SLICE = 2048
#: share by which a bound is lowered for the rounding of its floating-point steps
ROUNDING = 1e-12
#: largest component: 64 squared differences of twice this still fit into a long
LIMIT = 1 << 27


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """``vec_id`` and ``x`` = floor(256 * component) of the vectors with ``dim`` finite components."""
    return df.where((F.size(col(vector_col)) == dim) & finite_vector(vector_col)).select(
        col(id_col).cast("long").alias("vec_id"), integer_components(vector_col).alias("x")
    )


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All squared distances between two sets of integer vectors, exactly."""
    top = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if top < 1 << 22:  # every step of the floating-point product is an exact integer
        dot = (x.astype(float) @ c.astype(float).T).astype(np.int64)
    else:
        dot = x @ c.T
    return (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * dot


def pivot_pairs(pivots: np.ndarray) -> list[tuple[int, int]]:
    """Each pivot with its two nearest, its median and its farthest other pivot."""
    gap = squared(pivots, pivots)
    pairs = set()
    for p in range(len(pivots)):
        order = [int(s) for s in np.argsort(gap[p], kind="stable") if gap[p, s] > 0]
        if order:
            pairs |= {tuple(sorted((p, s))) for s in (*order[:2], order[len(order) // 2], order[-1])}
    return sorted(pairs)


class Bounds:
    """Lower bounds from cached pivot distances for one set of centroids."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.centroids = centroids
        self.pairs = pivot_pairs(pivots)
        self.between = np.sqrt(squared(pivots, pivots))
        self.reach = np.sqrt(squared(centroids, pivots))

    def lower(self, cached: np.ndarray) -> np.ndarray:
        """Squared distances from below, rounded downwards."""
        out = np.zeros((len(cached), len(self.centroids)))
        for p, s in self.pairs:
            a = cached[:, p, None] * self.reach[None, :, s]
            b = cached[:, s, None] * self.reach[None, :, p]
            np.maximum(out, (np.abs(a - b) - ROUNDING * (a + b)) / self.between[p, s], out=out)
        return out * out * (1.0 - ROUNDING)

    def nearest(self, x: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number), its squared distance, and how many were computed."""
        n, k = len(x), len(self.centroids)
        lower = self.lower(cached)
        order = np.argsort(lower, axis=1, kind="stable")
        best = np.full(n, np.iinfo(np.int64).max)
        label, checked = np.full(n, k), np.zeros(n, np.int64)
        rows = np.arange(n)
        for step in range(k):
            c = order[rows, step]
            open_ = lower[rows, c] <= best[rows]
            rows, c = rows[open_], c[open_]
            if not len(rows):
                break
            gap = x[rows] - self.centroids[c]
            d = (gap * gap).sum(1)
            checked[rows] += 1
            better = (d < best[rows]) | ((d == best[rows]) & (c < label[rows]))
            best[rows[better]], label[rows[better]] = d[better], c[better]
        return label, best, checked


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=kind).reshape(-1, width)


def _within(x: np.ndarray) -> np.ndarray:
    if np.abs(x).max(initial=0) > LIMIT:
        raise ValueError(f"a component beyond {LIMIT // 256} has distances that no long can hold")
    return x


def _slices(batches, dim: int, n_pivots: int):
    """Ids, vectors and cached distances, a slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part.column(0), _matrix(part.column(1), dim, np.int64), _matrix(part.column(2), n_pivots, float)


def with_pivot_distances(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its distances to the pivots, computed once."""
    dim = pivots.shape[1]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                x = _within(_matrix(part.column(1), dim, np.int64))
                cached = pa.array(list(np.sqrt(squared(x, pivots))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cached], names=["vec_id", "x", "cached"])

    return vectors.mapInArrow(run, "vec_id long, x array<long>, cached array<double>")


def cluster_sums(stored: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    """Number of vectors and componentwise sums of each non-empty cluster."""
    k, dim = centroids.shape

    def run(batches):
        bounds = Bounds(pivots, centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, x, cached in _slices(batches, dim, len(pivots)):
            label = bounds.nearest(x, cached)[0]
            count += np.bincount(label, minlength=k)
            np.add.at(total, label, x)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([count[c]], pa.int64()), pa.array([total[c]], pa.list_(pa.int64()))],
                names=["cluster", "n", "total"],
            )

    parts = stored.mapInArrow(run, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dim)]).alias("total")
    )
    return {r["cluster"]: (r["n"], np.array(r["total"], np.int64)) for r in sums.collect()}


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    """Non-empty centroids become the floor of their mean; empty ones stay."""
    out = centroids.copy()
    for c, (n, total) in sums.items():
        out[c] = total // n
    return out


def _fit_pivots(sample: np.ndarray, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Where the centroids end up on a sample: near a pivot the bounds are sharp."""
    pivots = centroids.copy()
    for _ in range(rounds):
        label = np.concatenate([squared(sample[at : at + SLICE], pivots).argmin(1) for at in range(0, len(sample), SLICE)])
        pivots = moved(pivots, {int(c): (int((label == c).sum()), sample[label == c].sum(0)) for c in np.unique(label)})
    return pivots


def cluster(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = PIVOT_SAMPLE,
) -> DataFrame:
    """Cluster of every vector after ``rounds`` of Lloyd's algorithm, with exact distances.

    Vectors that are null, of another length, or hold a null or non-finite
    component are left out.  Fewer than ``k`` vectors give fewer clusters, an
    empty table no rows.  Repeated rows are clustered one by one; a null id
    starts no centroid before any other id.  Of equal distances the smaller
    cluster number wins.  Other columns of the input are not looked at, so
    their names never clash.  ``n_checked`` is the number of exact distances that
    the last assignment computed for the vector (of ``k``).  Components beyond
    2**19 are an error, since their distances do not fit into a long.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vector_col, dim)
    start = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(start.asc_nulls_last(), "x").limit(k).collect()
    schema = T._parse_datatype_string(
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_checked int"
    )
    if not first:
        return spark.createDataFrame([], schema)
    centroids = _within(np.array([r["x"] for r in first], np.int64))
    # a row's number decides whether it is in the sample, so a common vector is not drawn whole
    numbered = vectors.select("x", F.monotonically_increasing_id().alias("row"))
    share = min(1.0, sample_rows / vectors.count())
    drawn = numbered.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))).select("x").collect()
    sample = _within(np.array([r["x"] for r in drawn], np.int64).reshape(-1, dim))
    pivots = _fit_pivots(sample, centroids, rounds)
    stored = materialize(with_pivot_distances(vectors, pivots), "centroid-vectors")
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(stored, pivots, centroids))

    def assign(batches):
        bounds = Bounds(pivots, centroids)
        for ids, x, cached in _slices(batches, dim, len(pivots)):
            label, best, checked = bounds.nearest(x, cached)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(label, pa.int32()), pa.array(best, pa.int64()), pa.array(checked, pa.int32())],
                names=["vec_id", "cluster", "distance", "n_checked"],
            )

    placed = materialize(
        stored.mapInArrow(assign, "vec_id long, cluster int, distance long, n_checked int"), "centroid-assigned"
    )
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    about = spark.createDataFrame(
        [
            (c, s, whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, s in sorted(inertia.items())
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # one row for each of the k clusters
    return placed.join(F.broadcast(about), "cluster").select(*[f.name for f in schema])


def sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The definition round by round for DuckDB; distances and sums are integers that a double holds exactly."""
    nearest = """SELECT rid, any_value(v) AS v, min(d * 1024 + c) % 1024 AS c, min(d * 1024 + c) // 1024 AS distance
  FROM (SELECT p.rid, p.v, q.c, CAST(p.n + list_inner_product(q.v, q.v) - 2 * list_inner_product(p.v, q.v) AS BIGINT) AS d
        FROM points p, {centres} q) GROUP BY rid"""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim})""",
        """points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, v, list_inner_product(v, v) AS n FROM kept)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept QUALIFY c < {k})""",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({nearest.format(centres=f'c{r}')})")
        parts.append(
            f"""m{r} AS (
  SELECT c, list(mean ORDER BY i) AS v FROM (
    SELECT c, i, floor((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) / count(*)) AS mean
    FROM (SELECT c, unnest(range(1, {dim + 1})) AS i, CAST(unnest(v) AS BIGINT) AS x FROM a{r}) GROUP BY c, i) GROUP BY c)"""
        )
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.c = o.c)")
    parts.append(f"last AS MATERIALIZED ({nearest.format(centres=f'c{rounds}')})")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT p.vec_id, CAST(l.c AS INTEGER) AS cluster, CAST(l.distance AS BIGINT) AS distance,
       CAST(sum(l.distance) OVER (PARTITION BY l.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(l.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(q.v, lambda e: CAST(e AS BIGINT)), ',')) AS centroid_sha256
FROM last l JOIN points p ON p.rid = l.rid JOIN c{rounds} q ON q.c = l.c"""
    )
