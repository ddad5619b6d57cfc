"""Operator 9: BPE encoding and decoding by a contiguous rank array.

A word's parts sit in one short array with the merge rank of each adjacent
pair beside it.  The smallest rank is searched again and again; the boundary
at it goes and the ranks of its two neighbours are looked up anew.  Words of
more than ``LONG`` symbols, where that scan would be quadratic, keep the same
order of merges with a heap.

Texts are cut at white space first: no pre-token of this vocabulary spans it,
so a chunk's ids do not depend on its neighbours and are remembered in a
bounded per-worker table.
"""

from __future__ import annotations

import gc
import hashlib
import heapq

from pyspark.sql import DataFrame

from ledgerlens.llm.common import map_texts
from ledgerlens.llm.vocabulary import Memo, Vocabulary, chunks, share, vocabulary, word_pieces

LONG = 256
#: chunks, and words, remembered by a worker, in each of two generations
REMEMBERED = 400_000
_NONE = 1 << 62


def merge_short(ids: list[int], rank: dict[int, int], made: list[int]) -> list[int]:
    """Merge a word in place by scanning its contiguous array of adjacent ranks."""
    get = rank.get
    ranks = [get(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:])]
    while ranks:
        low = min(ranks)
        if low == _NONE:
            break
        i = ranks.index(low)
        ids[i : i + 2] = [made[low]]
        del ranks[i]
        if i:
            ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], _NONE)
        if i < len(ranks):
            ranks[i] = get(ids[i] << 32 | ids[i + 1], _NONE)
    return ids


def merge_long(ids: list[int], rank: dict[int, int], made: list[int]) -> list[int]:
    """The same merges for a long word: a heap of (rank, place) over linked parts."""
    n = len(ids)
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i) for i in range(n - 1) if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if not live[i] or j >= n or rank.get(ids[i] << 32 | ids[j]) != r:
            continue
        ids[i], live[j], after[i] = made[r], False, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (s := rank.get(ids[k] << 32 | ids[after[k]])) is not None:
                heapq.heappush(heap, (s, k))
    return [x for x, alive in zip(ids, live) if alive]


def encode_word(word: str, voc: Vocabulary) -> list[int]:
    """Ids of one pre-token."""
    ids = voc.symbols(word)
    return (merge_short if len(ids) <= LONG else merge_long)(ids, voc.rank, voc.made)


def encode_parts(chunk: str, voc: Vocabulary) -> list:
    """A chunk's pre-tokens; a special string in it comes as its id."""
    if not voc.cut or "<|" not in chunk:
        return word_pieces(chunk)
    out: list = []
    for part in voc.cut.split(chunk):
        out += [voc.special[part]] if part in voc.special else word_pieces(part)
    return out


def encode_chunk(chunk: str, voc: Vocabulary) -> list[int]:
    """Ids of a chunk without white space."""
    return [i for w in encode_parts(chunk, voc) for i in (encode_word(w, voc) if isinstance(w, str) else [w])]


def encode_text(text: str | None, voc: Vocabulary) -> list[int]:
    return [i for chunk in chunks(text or "") for i in encode_chunk(chunk, voc)]


def decode(ids: list[int], voc: Vocabulary) -> str:
    """The library's decode for a vocabulary without a decoder: tokens joined by a space."""
    return " ".join(voc.token[i] for i in ids)


class Codec:
    """A worker's encoder, with bounded tables of known chunks and known words."""

    def __init__(self, voc: Vocabulary):
        gc.set_threshold(100_000, 50, 100)  # the tables hold no cycles; do not walk them often
        self.voc = voc
        self.words = Memo(REMEMBERED)  # pre-token -> ids
        self.chunks = Memo(REMEMBERED)  # chunk -> (number of ids, ids as decimals, tokens)

    def pieces(self, texts: list[str | None]) -> list[list[tuple[int, str, str]]]:
        """For each text the (count, ids, tokens) of its chunks."""
        split = [chunks(t or "") for t in texts]
        fresh = self.chunks.missing(set().union(*split))
        if fresh:
            parts = [encode_parts(c, self.voc) for c in fresh]
            words = self.words.missing({w for p in parts for w in p if w.__class__ is str})
            known = self.words.known
            known.update((w, encode_word(w, self.voc)) for w in words)
            token = self.voc.token.__getitem__
            for chunk, part in zip(fresh, parts):
                ids = [i for w in part for i in (known[w] if w.__class__ is str else (w,))]
                self.chunks.known[chunk] = (len(ids), " ".join(map(str, ids)), " ".join(map(token, ids)))
        get = self.chunks.known.__getitem__
        return [list(map(get, words)) for words in split]


_codecs: dict[int, Codec] = {}


def encode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every document: id, ``ids array<int>``, ``decoded string``.

    A null text counts as empty and gives an empty list and an empty string.
    Every row is encoded by itself, so repeated rows and extra columns do not
    matter; an empty table gives an empty result.
    """
    data = share(df.sparkSession, vocab_path)

    def make():
        voc = vocabulary(data.value)

        def work(texts):
            ids = [encode_text(t, voc) for t in texts]
            return None, [ids, [decode(x, voc) for x in ids]]

        return work

    return map_texts(df, text_col, make, "ids array<int>, decoded string", (id_col,))


def digest(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The round trip as digests: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    Same rules as :func:`encode`; the ids and the decoded text are hashed where
    they are made instead of leaving the task.
    """
    data = share(df.sparkSession, vocab_path)

    def make():
        voc = vocabulary(data.value)
        codec = _codecs.get(id(voc)) or _codecs.setdefault(id(voc), Codec(voc))

        def work(texts):
            count, ids, decoded = [], [], []
            for parts in codec.pieces(texts):
                count.append(sum(p[0] for p in parts))
                ids.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([p[2] for p in parts]).encode()).hexdigest())
            return None, [count, ids, decoded]

        return work

    return map_texts(df, text_col, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", (id_col,))
