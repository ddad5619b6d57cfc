"""Operator 2: near-duplicates by Order MinHash, verified by banded alignment.

A text's five-word shingles, labelled with their occurrence number, are
ordered by each of several hash functions; the two smallest, kept in text
order, are that function's sketch, so texts agree in a sketch only if they
share shingles in the same order.  Equal texts are one class from the start.

Classes that share a sketch of one of the first ``KEYS`` functions form a bucket.
Round one checks every class against those of its buckets' smallest members
with which ``MIN_AGREE`` sketches agree.  Round two checks, in blocks, all other
pairs of a bucket that are still in different components; there is no cap, and
agreement only orders the work.  A pair is a link if a banded alignment of the
two whole word sequences shows an edit similarity of ``SIMILARITY`` or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import col, map_texts
from ledgerlens.llm.components import Forest, components
from ledgerlens.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
FUNCTIONS = 24
#: functions whose sketches form buckets: at a shingle similarity of 0.8 all miss with 0.36**24, at 0.4 with 0.84**24
KEYS = 24
#: agreeing sketches that put a pair with a bucket's smallest member into round one; the others wait for round two
MIN_AGREE = 6
#: members of a bucket that are compared with as many others at once
BLOCK = 512
#: words of a block, where its members are long
BLOCK_WORDS = 1_000_000
#: candidates that a pair of blocks aligns before it looks again at what they joined
PAIRS = 256
#: cells of a text's word histogram, by which pairs are passed over before they are aligned
CELLS = 1024
#: cells of the alignment band, and words of the padded texts, that a batch of pairs holds at once
BAND_CELLS = 500_000
BATCH_WORDS = 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(words: np.ndarray, owner: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingle hashes in text order, and the document of each.

    A text of fewer than five words is one shingle.
    """
    n = len(words)
    end = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(n)
    first = at == end - np.repeat(lengths, lengths)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        inside = at + k < end
        word = np.where(inside, words[np.minimum(at + k, n - 1)], np.uint64(0))
        value = value * np.uint64(0x100000001B3) + word
    whole = (at + SHINGLE <= end) | first
    value, owner = _mix(value[whole]), owner[whole]
    order = np.lexsort((value, owner))  # stable, so equal shingles stay in text order
    same = np.r_[False, (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])]
    place = np.arange(len(order))
    label = np.empty(len(order), np.uint64)
    label[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return _mix(value + label * np.uint64(0x9E3779B97F4A7C15)), owner


def word_hashes(words: list[str]) -> np.ndarray:
    """A hash of each word: a polynomial of its UTF-8 bytes, mixed.  No word holds a space."""
    data = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), np.uint8)
    gap = np.flatnonzero(data == 32)
    start = np.r_[0, gap + 1]
    length = np.diff(np.r_[start, len(data) + 1])
    power = np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    term = power[np.arange(len(data) + 1) - np.repeat(start, length)][: len(data)]
    term *= data.astype(np.uint64) + np.uint64(1)
    term[gap] = 0
    return _mix(np.add.reduceat(term, start))


def sketches(texts: list[str | None]) -> tuple[list[int], list[list[int] | None]]:
    """The number of words of each text, and its order sketches (None without a word)."""
    split = [(t or "").lower().split() for t in texts]
    counts = [len(ws) for ws in split]
    out: list[list[int] | None] = [None] * len(texts)
    if not any(counts):
        return counts, out
    hashes = word_hashes([w for ws in split for w in ws])
    lengths = np.array(counts, np.int64)
    value, owner = shingles(hashes, np.repeat(np.arange(len(texts)), lengths), lengths)
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    size = np.diff(np.r_[start, len(owner)])
    docs = owner[start]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    # the low bits of a key hold the place in the document, so a minimum brings its place along
    low = (np.uint64(1) << np.ceil(np.log2(size + 1)).astype(np.uint64)) - np.uint64(1)
    place = (np.arange(len(value)) - np.repeat(start, size)).astype(np.uint64)
    high = ~np.repeat(low, size)
    made = np.zeros((len(docs), FUNCTIONS), np.uint64)
    for j in range(FUNCTIONS):
        salt, factor = _mix(np.array([2 * j + 1, 2 * j + 2], np.uint64))
        key = value ^ salt
        key *= factor | np.uint64(1)
        key ^= key >> np.uint64(32)
        key &= high
        key |= place
        a = start + (np.minimum.reduceat(key, start) & low).astype(np.int64)
        key[a] = top
        b = start + np.minimum((np.minimum.reduceat(key, start) & low).astype(np.int64), size - 1)
        b = np.where(size == 1, a, b)
        a, b = np.minimum(a, b), np.maximum(a, b)
        made[:, j] = _mix(value[a] * np.uint64(3) + _mix(value[b]) + np.uint64(j))
    for doc, row in zip(docs, made.view(np.int64).tolist()):
        out[doc] = row
    return counts, out


def edit_limit(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Most edits at which two sequences still have the similarity."""
    return int((1 - similarity) * max(n, m) + 1e-9)


def alignments(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> np.ndarray:
    """Whether each pair of word sequences has an edit similarity of ``similarity`` or more.

    A pair starts with the narrowest band that its shared words and word pairs
    allow; the band doubles, up to the edits that the similarity allows, as soon
    as every way inside it costs more than it is wide.  Pairs are aligned in batches.
    """
    verdict = np.zeros(len(pairs), bool)
    left: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    todo: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(pairs):
        limit = edit_limit(len(a), len(b), similarity)
        if abs(len(a) - len(b)) > limit:
            continue
        # equal ends cost nothing
        n = min(len(a), len(b))
        front = n if not (diff := a[:n] != b[:n]).any() else int(diff.argmax())
        a, b = a[front:], b[front:]
        n = min(len(a), len(b))
        back = 0 if not n else n if not (diff := a[::-1][:n] != b[::-1][:n]).any() else int(diff.argmax())
        a, b = a[: len(a) - back], b[: len(b) - back]
        if not len(a) or not len(b):
            verdict[i] = max(len(a), len(b)) <= limit
            continue
        # an edit takes away one shared word and at most two shared word pairs
        _, code = np.unique(np.r_[a, b], return_inverse=True)
        a, b, longer = code[: len(a)], code[len(a) :], max(len(a), len(b))
        least = longer - _common(a, b)
        if least <= limit and min(len(a), len(b)) > 1:
            span = int(code.max()) + 1
            least = max(least, -(-(longer - 1 - _common(a[:-1] * span + a[1:], b[:-1] * span + b[1:])) // 2))
        if least > limit:
            continue
        left[i] = (a.astype(np.int32) + 1, b.astype(np.int32) + 1, limit)
        band = 8
        while band < least:
            band *= 2
        todo.setdefault(min(band, limit), []).append(i)
    while todo:
        band = min(todo)
        ready = sorted(todo.pop(band), key=lambda i: max(len(left[i][0]), len(left[i][1])))
        at = 0
        while at < len(ready):
            # as many pairs as fit into the cells, by the band and by the length of the longest
            longest = [max(len(left[i][0]), len(left[i][1])) for i in ready[at : at + BAND_CELLS // (2 * band + 1) // 8 + 1]]
            size = np.arange(1, len(longest) + 1)
            fits = (size * (2 * band + 1) * 8 <= BAND_CELLS) & (size * np.array(longest) <= BATCH_WORDS)
            batch = ready[at : at + max(1, int(fits.sum()))]
            at += len(batch)
            edits = _banded([left[i][:2] for i in batch], band)
            for i, d in zip(batch, edits):
                limit = left[i][2]
                verdict[i] = d <= min(band, limit)
                if d > band and band < limit:
                    todo.setdefault(min(band * 2, limit), []).append(i)
    return verdict


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two bags."""
    _, code = np.unique(np.r_[a, b], return_inverse=True)
    k = int(code.max()) + 1
    return int(np.minimum(np.bincount(code[: len(a)], minlength=k), np.bincount(code[len(a) :], minlength=k)).sum())


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distances of pairs of sequences inside a diagonal band; a large number for those beyond ``band``.

    A pair leaves the batch when every entry of its row is more than the band,
    since entries never fall from row to row.
    """
    far = np.int32(1 << 29)
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    width = 2 * band + 1
    first = np.zeros((len(pairs), n.max()), np.int32)
    second = np.full((len(pairs), n.max() + m.max() + 2 * width), -1, np.int32)
    for p, (a, b) in enumerate(pairs):
        first[p, : len(a)] = a
        second[p, band + 1 : band + 1 + len(b)] = b
    step = np.arange(width, dtype=np.int32)
    j = step - np.int32(band)  # column minus row
    row = np.where(j >= 0, j, far).astype(np.int32)[None, :].repeat(len(pairs), 0)
    out = np.full(len(pairs), int(far))
    who = np.arange(len(pairs))
    edge = np.full((len(pairs), 1), far, np.int32)
    for i in range(1, int(n.max()) + 1):
        differ = second[:, i : i + width] != first[:, i - 1 : i]
        up = np.concatenate([row[:, 1:], edge[: len(row)]], 1)
        up += np.int32(1)
        row = np.minimum(row + differ, up)
        if i <= band:
            row[:, : band - i] = far
            row[:, band - i] = i
        row -= step
        np.minimum.accumulate(row, 1, out=row)
        row += step
        done = np.flatnonzero(n[who] == i)
        if len(done):
            at = m[who[done]] - i + band
            fits = (at >= 0) & (at < width)
            out[who[done[fits]]] = row[done[fits], at[fits]]
        if len(done) or i % 8 == 0:
            stay = (row.min(1) <= band) & (n[who] > i)
            if not stay.any():
                break
            if len(done) or stay.mean() < 0.75:
                who, first, second, row = who[stay], first[stay], second[stay], row[stay]
    return out


def _verified(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links among candidate pairs ``u``, ``v``; whole texts are aligned."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    texts = materialize(docs.join(wanted.hint("shuffle_hash"), "id").dropDuplicates(["id"]), "candidates")
    both = (
        pairs.join(texts.select(F.col("id").alias("v"), F.col("text").alias("tv")), "v")
        .join(texts.select(F.col("id").alias("u"), F.col("text").alias("tu")), "u")
        .select("u", "v", "tu", "tv")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                code: dict[str, int] = {}

                def words(text: str) -> np.ndarray:
                    return np.array([code.setdefault(w, len(code)) for w in text.lower().split()], np.int64)  # noqa: B023

                pairs_here = [(words(a), words(b)) for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield part.select([0, 1]).filter(pa.array(alignments(pairs_here, similarity)))

    return materialize(both.mapInArrow(check, pairs.select("u", "v").schema), "links")


def _agree(a: str, b: str) -> F.Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Near-duplicate groups: one row per document.

    Returns the id, ``class_id`` (smallest id with an equal text), ``component_id``
    (smallest id reachable by links) and ``kept`` (the id is the component's).
    Texts that are null or hold no word, and rows with a null id, join no group:
    they are their own class and are kept.  Rows that repeat an id are one
    document.  The id must be an integer.
    """

    def make():
        def work(texts):
            words, made = sketches(texts)
            digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() if s else None for t, s in zip(texts, made)]
            return None, [digests, words, made]

        return work

    signed = materialize(
        map_texts(df, text_col, make, "digest binary, words int, sketch array<long>", (id_col,)).withColumnRenamed(id_col, "id"),
        "sketches",
    )
    usable = signed.where("id IS NOT NULL AND sketch IS NOT NULL")
    classes = materialize(
        usable.groupBy("digest").agg(F.min("id").alias("class"), F.first("words").alias("words"), F.first("sketch").alias("sketch")),
        "classes",
    )
    keyed = materialize(
        classes.select("class", "words", F.posexplode(F.slice("sketch", 1, KEYS)).alias("j", "s")).select(
            "class", "words", "j", F.xxhash64("j", "s").alias("key")
        ),
        "keys",
    )
    buckets = materialize(
        keyed.groupBy("key")
        .agg(F.min("class").alias("leader"), F.count(F.lit(1)).alias("n"), F.sum("words").alias("total"))
        .where("n > 1"),
        "buckets",
    )
    members = materialize(keyed.drop("words").join(buckets, "key"), "members")
    sides = {
        s: classes.select(F.col("class").alias(s), F.col("words").alias(f"w_{s}"), F.col("sketch").alias(f"s_{s}")) for s in "uv"
    }
    stars = materialize(members.where("class <> leader").select(F.col("leader").alias("u"), F.col("class").alias("v")).distinct(), "stars")
    stars = materialize(
        stars.join(sides["v"], "v")
        .join(sides["u"], "u")
        .where(_agree("s_u", "s_v") >= MIN_AGREE)
        .where(F.least("w_u", "w_v") >= F.floor(F.lit(similarity) * F.greatest("w_u", "w_v")))
        .select("u", "v"),
        "stars",
    )
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    links = _verified(stars, docs, similarity)
    found = components(links)
    more = materialize(_cross_links(members, classes, docs, found, similarity), "links")
    found = components(links.unionByName(more))
    grouped = materialize(
        classes.join(found.select(F.col("node").alias("class"), "root"), "class", "left").select(
            "digest", "class", F.coalesce("root", "class").alias("component")
        ),
        "groups",
    )
    out = signed.select("id", F.when(F.col("sketch").isNotNull() & F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(
        grouped, "digest", "left"
    )
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("class", "id").alias("class_id"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def _cross_links(members: DataFrame, classes: DataFrame, docs: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Links between classes of a bucket that are in different components so far.

    A pair belongs to the bucket of the first function whose sketches agree, so
    it is compared once.  A pair of blocks aligns its candidates, those that
    agree most first, and passes over pairs that its own links have joined by
    then: a spanning forest leaves the task, not all pairs.
    """
    known = found.select(F.col("node").alias("class"), "root")
    placed = materialize(
        members.join(known, "class", "left").select("key", "j", "class", "leader", "n", "total", F.coalesce("root", "class").alias("part")),
        "placed",
    )
    split = materialize(
        placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("key"), "split"
    )
    rows = materialize(placed.join(split, "key"), "open")
    wanted = rows.select(F.col("class").alias("id")).distinct()
    texts = docs.join(wanted.hint("shuffle_hash"), "id").dropDuplicates(["id"]).withColumnRenamed("id", "class")
    texts = materialize(texts.join(classes.select("class", "words", "sketch"), "class"), "candidates")
    rows = rows.join(texts, "class")
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(BLOCK), F.col("total") / F.lit(BLOCK_WORDS))).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("b", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # a block meets every block of its bucket once
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "key",
        F.least("b", "other").alias("lo"),
        F.greatest("b", "other").alias("hi"),
        "b",
        "j",
        "class",
        "leader",
        "part",
        "words",
        "sketch",
        "text",
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        lo, hi, j, leader = (group[c].iloc[0] for c in ("lo", "hi", "j", "leader"))
        group = group.sort_values(["b", "class"], ignore_index=True)
        ids, part, size = (group[c].to_numpy() for c in ("class", "part", "words"))
        sketch = np.array(group["sketch"].tolist(), np.int64)
        others = np.arange(len(group)) if lo == hi else np.flatnonzero(group["b"].to_numpy() == hi)
        mine = others if lo == hi else np.flatnonzero(group["b"].to_numpy() == lo)
        met_here = []
        for k in mine:
            rest = others[others > k]
            rest = rest[part[rest] != part[k]]
            rest = rest[np.minimum(size[rest], size[k]) >= np.floor(similarity * np.maximum(size[rest], size[k]))]
            same = sketch[rest] == sketch[k]
            agree = same.sum(1)
            # round one has compared the leader with those that agree enough
            known = ((ids[rest] == leader) | (ids[k] == leader)) & (agree >= MIN_AGREE)
            ok = ~known & (same[:, :KEYS].argmax(1) == j)
            if ok.any():
                met_here.append((k, rest[ok], agree[ok]))
        code: dict[str, int] = {}
        coded: dict[int, np.ndarray] = {}

        def words(i: int) -> np.ndarray:
            if i not in coded:
                coded[i] = np.array([code.setdefault(w, len(code)) for w in group["text"].iloc[i].lower().split()], np.int64)
            return coded[i]

        # words without a counterpart bound the edits from below, also when several words share a cell
        involved = np.unique(np.concatenate([np.r_[k, rest] for k, rest, _ in met_here])) if met_here else []
        place = {int(i): p for p, i in enumerate(involved)}
        cells = np.zeros((len(involved), CELLS), np.int32)
        for i, p in place.items():
            cells[p] = np.bincount(words(i) % CELLS, minlength=CELLS)
        pairs: list[tuple[int, int, int]] = []
        for k, rest, agree in met_here:
            common = np.minimum(cells[place[int(k)]], cells[[place[int(x)] for x in rest]]).sum(1)
            longer = np.maximum(size[rest], size[k])
            ok = longer - common <= (1 - similarity) * longer + 1e-9
            pairs += zip((-agree[ok]).tolist(), [int(k)] * int(ok.sum()), rest[ok].tolist())
        pairs.sort()

        forest, out = Forest(), []
        for at in range(0, len(pairs), PAIRS):
            batch = [(u, v) for _, u, v in pairs[at : at + PAIRS] if forest.find(part[u]) != forest.find(part[v])]
            for (u, v), linked in zip(batch, alignments([(words(u), words(v)) for u, v in batch], similarity)):
                if linked and forest.join(part[u], part[v]):
                    out.append((min(ids[u], ids[v]), max(ids[u], ids[v])))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return met.groupBy("key", "lo", "hi").applyInPandas(compare, "u long, v long").distinct()
