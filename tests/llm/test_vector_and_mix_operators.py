"""Operators 11, 12 and 13 against their laws, brute force and SQL."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import centroids, hard_negatives, mixing

DOCUMENT = "doc_id long, text string, source string"
VECTOR = "vec_id long, embedding array<double>, label int"


# ------------------------------------------------------------------ 11 -----
def test_targets_share_by_weight_and_stop_at_twice_the_source():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == pytest.approx([200, 250 / 3, 500 / 3])
    # the first two are full, and what they leave goes to the third by weight
    got = mixing.targets([10, 10, 1000, 0], [3, 1, 2, 3])
    assert got == pytest.approx([20, 20, 1490, 0])
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [3, 1]) == [0, 0]


def test_splitting_tree_gives_exact_quotas_and_the_right_law():
    quota, shards = np.array([500, 37, 0, 463]), 13
    leaves = list(mixing.split(quota, shards, seed=4))
    have, before = np.array([h for _, h, _ in leaves]), np.array([b for _, _, b in leaves])
    assert [s for s, _, _ in leaves] == list(range(shards))
    assert (have.sum(0) == quota).all()
    assert list(have.sum(1)) == [77] * 12 + [76]
    assert (before == np.cumsum(have, axis=0) - have).all()
    # a task that expands a part of the tree finds the same leaves
    for lo, hi in ((0, 1), (5, 9), (12, 13)):
        for (s, h, b), (s2, h2, b2) in zip(mixing.split(quota, shards, 4, (lo, hi)), leaves[lo:hi]):
            assert s == s2 and (h == h2).all() and (b == b2).all()
    # blocks of source 1 in shard 12 are hypergeometric: 76 drawn of 1000, 37 of them of that source
    seen = np.array([list(mixing.split(quota, shards, seed, (12, 13)))[0][1][1] for seed in range(3000)])
    mean = 76 * 37 / 1000
    spread = mean * (1 - 37 / 1000) * (1000 - 76) / 999
    assert abs(seen.mean() - mean) < 5 * np.sqrt(spread / 3000)
    assert abs(seen.var() - spread) < 0.15 * spread


def test_fill_comes_as_near_as_it_can():
    assert list(mixing._fill(np.array([5, 5, 9, 0, 3, 2]), 14.0)) == [0, 1, 4]
    assert list(mixing._fill(np.array([100, 100]), 60.0)) == [0]  # 40 over is nearer than 60 short
    assert list(mixing._fill(np.array([100, 100]), 40.0)) == []
    assert list(mixing._fill(np.array([0, 7]), 0.0)) == [0]


def _documents():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        source = None if i % 40 == 0 else ("hot" if i % 3 == 0 else f"s{i % 4}")
        words = int(rng.integers(0, 60)) if i != 77 else 30_000
        rows.append((i, " ".join(["wörd"] * words) + "\x0b\x1f" * (i % 2), source))
    rows += [(5000, None, "s1"), (5001, "", "s1"), (None, "a b c", "s2"), (None, "a b c", "s2"), (5002, None, "void")]
    rows += [(6000, "one two three", "many")] * 400  # a row repeated past a cell
    return rows


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rows = _documents()
    df = spark.createDataFrame(rows, DOCUMENT).withColumn("copy", F.lit("x")).withColumn("words", F.lit(1))
    got = mixing.taken(df, cell_docs=60).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    assert all(r.taken == r.size * r.copies and r.copies <= 2 for r in got)
    names = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = [sum(size(t) for _, t, s in rows if s == name) for name in names]
    want = mixing.targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(names))])
    known = sorted({(r.source_size, r.target) for r in got})
    assert known == [(s, pytest.approx(t)) for s, t in sorted(zip(sizes, want))]
    for name, s, t in zip(names, sizes, want):
        mixed = sum(r.taken for r in got if r.source_size == s)
        # whole documents: half of the long one where there is nothing else left
        assert abs(mixed - t) <= (15_000 if name == "s1" else 30), name
    again = mixing.taken(spark.createDataFrame(rows, DOCUMENT).repartition(7), cell_docs=60).collect()
    once = lambda part: sorted((r.doc_id, r.taken) for r in part if r.doc_id is not None and r.doc_id != 6000)
    assert once(again) == once(got)


def test_mix_places_every_copy_once(spark):
    df = spark.createDataFrame(_documents(), DOCUMENT).withColumn("shard", F.lit("clash"))
    made = mixing.mix_documents(df, block_docs=8, shard_blocks=4, cell_docs=60)
    assert made.columns == ["doc_id", "text", "source", "source_size", "target", "copy", "shard", "slot"]
    rows = made.where("copy IS NOT NULL").select("source", "shard", "slot").collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    blocks = sum(-(-sum(r.source == s for r in rows) // 8) for s in {r.source for r in rows})
    assert len(shards) == -(-blocks // 4) > 20
    for part in shards.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert len(part) <= 4 * 8
    assert made.where("copy IS NULL AND (shard IS NOT NULL OR slot IS NOT NULL)").count() == 0


def test_mix_empty_and_wordless_tables(spark):
    assert mixing.taken(spark.createDataFrame([], DOCUMENT)).count() == 0
    rows = mixing.taken(spark.createDataFrame([(1, None, None), (None, "", "s")], DOCUMENT)).collect()
    assert sorted((r.taken, r.target) for r in rows) == [(0, 0.0), (0, 0.0)]


# ------------------------------------------------------------------ 12 -----
def _lloyd(rows, k, rounds, dim):
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows if v and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    start = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [v for _, v in sorted(good, key=start)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in good]
        for n in range(len(centres)):
            mine = [v for (_, v), o in zip(good, own) if o == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine)]
    last = [(i, *nearest(v)[::-1]) for i, v in good]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    total = sum(d for _, _, d in last)
    return [(i, n, d, sum(e for _, m, e in last if m == n), total, digest[n]) for i, n, d in last]


def _vectors(dim=6, n=240):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=dim)], int(i % 4)) for i in range(n)]
    rows += [(7, [float(x) for x in rng.normal(size=dim)], 1), (7, rows[7][1], 3)]  # repeated ids
    rows += [(None, [1.0] * dim, 2), (300, [1.0] * dim, 2), (301, [1.0] * dim, 2)]  # ties
    rows += [(302, None, 1), (303, [], 1), (304, [None] + [1.0] * (dim - 1), 1), (305, [float("nan")] * dim, 1)]
    rows += [(306, [float("inf")] * dim, 1), (307, [0.5] * (dim + 1), 1), (308, [0.0] * dim, None), (350, [0.25] * dim, None)]
    return rows


def _order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


@pytest.mark.parametrize("k,sample", [(9, 20_000), (9, 3), (500, 20_000)])
def test_centroids_equal_plain_lloyd(spark, k, sample):
    rows = _vectors()
    df = spark.createDataFrame(rows, VECTOR).withColumn("cluster", F.lit("clash")).withColumn("x", F.lit(1))
    got = centroids.cluster(df, k=k, rounds=4, dim=6, sample_rows=sample).collect()
    assert _order(tuple(r)[:6] for r in got) == _order(_lloyd(rows, k, 4, 6))


def test_centroids_of_an_empty_table(spark):
    df = centroids.cluster(spark.createDataFrame([], VECTOR))
    assert df.count() == 0 and "n_checked" in df.columns


def test_ptolemaic_bounds_never_exceed_distances_and_prune_clustered_vectors():
    rng = np.random.default_rng(2)
    centre = rng.integers(-4000, 4000, size=(30, 16))
    x = np.repeat(centre, 60, axis=0) + rng.integers(-60, 60, size=(1800, 16))
    start = x[::60][:30]
    pivots = centroids._fit_pivots(x[::7], start, 4)
    cached = np.sqrt(centroids.squared(x, pivots))
    for now in (start, centroids._fit_pivots(x, start, 2), centroids._fit_pivots(x, start, 5)):
        bounds = centroids.Bounds(pivots, now)
        exact = centroids.squared(x, now)
        assert (bounds.lower(cached) <= exact).all()
        label, best, checked = bounds.nearest(x, cached)
        assert (label == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert checked.mean() < 0.1 * len(now)


def test_squared_distances_beyond_exact_doubles():
    x = np.array([[1 << 27, -(1 << 27)], [3, 4]], np.int64)
    assert centroids.squared(x, x)[0, 1] == ((1 << 27) - 3) ** 2 + ((1 << 27) + 4) ** 2
    with pytest.raises(ValueError, match="no long can hold"):
        centroids._within(x * 2)


# ------------------------------------------------------------------ 13 -----
def _mined(rows):
    part = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        part.append((n, i, label, [int(np.floor(256 * x)) for x in v]))
    out = []
    first = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    for n, i, label, v in part:
        if i is None or i % 50:
            continue
        scored = [
            (sum(a * b for a, b in zip(v, w)), j, m, other)
            for m, j, other, w in part
            if m != n and len(w) == len(v)
        ]
        for ps, j, _, _ in sorted((s for s in scored if s[3] == label), key=first)[:5]:
            band = [s for s in scored if s[3] != label and 50 * ps <= 100 * s[0] <= 95 * ps]
            out += [(i, j, rank, s[1], ps, s[0]) for rank, s in enumerate(sorted(band, key=first)[:3], 1)]
    return out


@pytest.mark.parametrize("dim,blocks", [(6, {}), (6, {"block_rows": 40, "block_anchors": 2}), (70, {"block_rows": 64})])
def test_hard_negatives_equal_brute_force(spark, dim, blocks):
    rows = [(i, v, label) for i, v, label in _vectors(dim)]
    rows += [(400, rows[50][1], 2), (50, rows[50][1], rows[50][2]), (450, [], 1), (451, [], 2), (452, [], 1)]
    df = spark.createDataFrame(rows, VECTOR).withColumn("rank", F.lit("clash")).withColumn("row", F.lit(1))
    got = [tuple(r) for r in hard_negatives.mine(df, **blocks).collect()]
    want = _mined(rows)
    assert _order(got) == _order(want) and len(want) > 30


def test_hard_negatives_of_an_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTOR)).count() == 0


def test_intervals_hold_and_prune():
    """Intervals of every level contain the score, and few rows are left to score exactly."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    turns = hard_negatives.rotations(64)
    codes = hard_negatives.Codes(64, *hard_negatives.Codes.of(x, turns))
    assert (codes.left[-1] < 0.05 * np.linalg.norm(x, axis=1)).all()
    scored, limits = 0, np.array([[9000, 17000], [12000, 15000]])
    queries = hard_negatives.Queries(x[:40], turns)
    for i in range(40):
        exact = x @ x[i]

        def check(rows, low, high):
            assert (low <= exact[rows]).all() and (exact[rows] <= high).all()
            return hard_negatives.in_bands(low, high, limits, 3)

        left = hard_negatives.survivors(queries, i, codes, slice(0, len(x)), check)
        for bottom, top in limits:
            inside = np.flatnonzero((exact >= bottom) & (exact <= top))
            assert set(inside[np.argsort(-exact[inside], kind="stable")[:3]]) <= set(left)
        scored += len(left)
    assert scored < 0.2 * 40 * len(x)


def test_bands_are_exact_for_any_sign_and_size():
    for p in (0, 1, 7, 19, 20, 99, 101, -5, -101, (1 << 60) + 3):
        low, high = (int(v) for v in hard_negatives.bands(np.array([p]))[0])
        assert 50 * p <= 100 * low and 100 * (low - 1) < 50 * p
        assert 100 * high <= 95 * p and 95 * p < 100 * (high + 1)
