"""Operator 6: token counts by rank-synchronous merging of ragged arrays.

Pre-tokens not met before are held together as one ragged numpy array.  In
each round every sequence finds its own lowest merge rank, all places with
that rank merge at once (the leftmost of overlapping ones), and the array is
compacted.  What is left of a sequence is its token count.  Merging all
places of one rank together is exact because a merged symbol only takes part
in merges of a later rank.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from ledgerlens.llm.common import map_texts
from ledgerlens.llm.vocabulary import SPACE, Memo, Vocabulary, byte_pieces, share, vocabulary

#: chunks remembered by a worker, in each of two generations
REMEMBERED = 500_000
#: symbols held in one ragged array
BATCH_SYMBOLS = 400_000

# White space other than single blanks between two visible characters.
_loose = re.compile(f"[{SPACE}] | [{SPACE}]|^[{SPACE}]|[{SPACE}]$")


class Ranks:
    """Pair ranks as sorted arrays, for whole arrays of pairs at once."""

    def __init__(self, voc: Vocabulary):
        keys = np.fromiter(voc.rank.keys(), np.int64, len(voc.rank))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(voc.rank.values(), np.int64, len(voc.rank))[order]
        self.made = np.array(voc.made, np.int64)
        self.none = np.int64(len(voc.made))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], self.none)


def survivors(symbols: np.ndarray, lengths: np.ndarray, ranks: Ranks) -> np.ndarray:
    """Symbols that are left of each sequence after all merges."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    left = lengths.copy()
    # rank of the pair that starts at each place; none across sequences
    rank = np.full(len(symbols), ranks.none)

    def refresh(at: np.ndarray) -> None:
        at = at[(at >= 0) & (at < len(symbols) - 1)]
        same = owner[at] == owner[at + 1]
        rank[at[~same]] = ranks.none
        at = at[same]
        rank[at] = ranks.of(symbols[at], symbols[at + 1])

    refresh(np.arange(len(symbols) - 1))
    while len(symbols):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[first, len(symbols)])
        low = np.minimum.reduceat(rank, first)
        live = low < ranks.none
        if not live.all():  # sequences that are done leave the array
            stay = np.repeat(live, size)
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            size, low = size[live], low[live]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == np.repeat(low, size))
        # of a run of overlapping places every second one merges
        start = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])]
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0]
        symbols[at] = ranks.made[rank[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        left -= np.bincount(owner[at], minlength=len(left))
        at = np.cumsum(stay)[at] - 1
        symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
        rank[-1] = ranks.none
        refresh(at)
        refresh(at - 1)
    return left


class Counter:
    """Token counts of texts, with a bounded table of known chunks.

    A chunk is a text's part up to a single blank between visible characters;
    such a blank always starts a new pre-token, so chunks count by themselves.
    """

    def __init__(self, voc: Vocabulary):
        self.voc, self.ranks, self.memo = voc, Ranks(voc), Memo(REMEMBERED)
        self.byte_id = np.array(voc.byte_id, np.int64)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Special tokens in a text, and its chunks with their leading blank."""
        found, out = 0, []
        for k, piece in enumerate(self.voc.cut.split(text) if self.voc.cut else [text]):
            if k % 2:
                found += 1
            elif not piece:
                continue
            elif _loose.search(piece):
                out += byte_pieces(piece)
            else:
                first, *rest = piece.split(" ")
                out.append(first)
                out += [" " + x for x in rest]
        return found, out

    def learn(self, fresh: list[str]) -> None:
        """Count the tokens of new chunks together, a ragged array at a time."""
        words, owner = [], []
        size = 0
        done = 0
        for i, chunk in enumerate(fresh):
            for w in byte_pieces(chunk):
                raw = w.encode("utf-8", "surrogatepass")
                words.append(raw)
                owner.append(i - done)
                size += len(raw)
            if size >= BATCH_SYMBOLS or i == len(fresh) - 1:
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
                n = survivors(symbols, lengths, self.ranks)
                total = np.bincount(owner, weights=n, minlength=i + 1 - done).astype(np.int64)
                self.memo.known.update(zip(fresh[done : i + 1], total.tolist()))
                words, owner, size, done = [], [], 0, i + 1

    def count(self, texts: list[str | None]) -> list[int]:
        split = [self.parts(t or "") for t in texts]
        fresh = self.memo.missing(set().union(*[p for _, p in split]))
        if fresh:
            self.learn(fresh)
        get = self.memo.known.__getitem__
        return [found + sum(map(get, parts)) for found, parts in split]


_counters: dict[int, Counter] = {}


def token_counts(
    df: DataFrame, vocab_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every document: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    A null text counts as empty (0 bytes, 0 tokens).  A special string inside a
    text is one token.  Each row counts by itself, so ties, repeated rows and
    extra columns change nothing; an empty table gives an empty result.
    """
    data = share(df.sparkSession, vocab_path)

    def make():
        voc = vocabulary(data.value)
        counter = _counters.get(id(voc)) or _counters.setdefault(id(voc), Counter(voc))

        def work(texts):
            n = counter.count(texts)
            size = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            return None, [size, n, [x > limit for x in n]]

        return work

    return map_texts(df, text_col, make, "n_bytes long, n_tokens long, over_limit boolean", (id_col,))
