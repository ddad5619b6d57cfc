"""Operator 7: quality rules from a suffix array's repeated substrings.

The words of a slice of documents form one integer string with a boundary
after each document.  Prefix doubling sorts its suffixes; the longest common
prefix of neighbours in that order comes from the kept ranks of each doubling.
Runs of neighbours with a prefix of ``least`` words or more are the LCP
intervals of repeated substrings; the union of their spans is the repeated
part of the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ledgerlens.llm.common import map_texts

#: words sorted together; a longer document is sorted by itself
SLICE_WORDS = 150_000
# Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_is_symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))


def longest_repeats(word: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place the length of the longest substring from there that occurs elsewhere in its document.

    Also the places in suffix order, and the common prefix of each with the next.
    """
    n = len(word)
    _, rank = np.unique(owner * (word.max() + 1) + word, return_inverse=True)
    rank = rank.astype(np.int64)
    levels, step = [rank], 1
    while True:
        order = np.argsort(rank, kind="stable")
        if rank[order[-1]] == n - 1:
            break
        ahead = np.zeros(n, np.int64)
        inside = np.flatnonzero(owner[:-step] == owner[step:]) if step < n else np.zeros(0, np.int64)
        ahead[inside] = rank[inside + step] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[0, key[order[1:]] != key[order[:-1]]])
        rank, step = new, step * 2
        levels.append(rank)
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    end = np.searchsorted(owner, owner, side="right")
    for k in range(len(levels) - 1, -1, -1):
        # places whose next 2**k words lie in their documents and are equal
        x, y = a + common, b + common
        fits = (x + (1 << k) <= end[a]) & (y + (1 << k) <= end[b])
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        common += (fits & (levels[k][x] == levels[k][y])) << k
    best = np.zeros(n, np.int64)
    best[a] = common
    best[b] = np.maximum(best[b], common)
    return best, order, common


def _covered(best: np.ndarray, least: int, span: np.ndarray | int) -> np.ndarray:
    """Places inside a span that starts where a repeat of ``least`` words does."""
    at = np.arange(len(best))
    return np.maximum.accumulate(np.where(best >= least, at + span, 0)) > at


def measure(texts: list[str | None], least: int) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition figures of each text."""
    docs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words = [d.split() for d in docs]  # bytes split at the six ASCII white space characters only
    n = np.array([len(w) for w in words], np.int64)
    out = {k: np.zeros(len(texts), np.int64) for k in ("chars", "symbols", "dup_lines", "repeat_words", "covered", "longest", "repeats")}
    out["words"] = n
    for i, (text, raw) in enumerate(zip(texts, docs)):
        if n[i]:
            white = sum(map(raw.count, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")))
            out["chars"][i] = len(text) - white
            out["symbols"][i] = int(_is_symbol[np.frombuffer(raw, np.uint8)].sum())
            lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
            out["dup_lines"][i] = len(lines) - len(set(lines))
    start = 0
    while start < len(texts):
        stop = start + 1
        total = n[start]
        while stop < len(texts) and total + n[stop] <= SLICE_WORDS:
            total += n[stop]
            stop += 1
        if total > 1:
            _repeats(words[start:stop], n[start:stop], least, {k: v[start:stop] for k, v in out.items()})
        start = stop
    return out


def _repeats(words: list[list[bytes]], n: np.ndarray, least: int, out: dict[str, np.ndarray]) -> None:
    code: dict[bytes, int] = {}
    word = np.array([code.setdefault(w, len(code)) for doc in words for w in doc], np.int64)
    size = np.array([len(w.decode("utf-8", "surrogatepass")) for w in code], np.int64)[word]
    owner = np.repeat(np.arange(len(n)), n)
    best, order, common = longest_repeats(word, owner)
    many = len(n)
    out["repeat_words"][:] = np.bincount(owner, _covered(best, 3, 3), many)
    out["covered"][:] = np.bincount(owner, _covered(best, least, best) * size, many)
    np.maximum.at(out["longest"], owner, best)
    opens = (common >= least) & np.r_[True, common[:-1] < least]
    out["repeats"][:] = np.bincount(owner[order[:-1][opens]], minlength=many)


def rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 5,
    max_covered: float = 0.5,
    max_longest: int = 100,
) -> DataFrame:
    """Quality figures and verdict of every document.

    Base rules (``base_failed``): under 50 words, or more than half of the words in
    repeated 3-word windows.  The method's verdict: repeats of ``least`` words or
    more cover at most ``max_covered`` of the word characters and the longest is
    at most ``max_longest`` words.  ``kept`` needs both.  A null or empty text has
    zero words, so it fails the base rule; repeated rows and extra columns change
    nothing.
    """

    def make():
        def work(texts):
            m = measure(texts, least)
            failed = (m["words"] < 50) | (100 * m["repeat_words"] > 50 * m["words"])
            share = m["covered"] / np.maximum(m["chars"], 1)
            good = (share <= max_covered) & (m["longest"] <= max_longest)
            cols = [m["words"], m["chars"], m["symbols"], m["dup_lines"], m["repeat_words"], failed, ~failed & good]
            return None, [*cols, m["repeats"], share, m["longest"]]

        return work

    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
        " kept boolean, n_repeats long, covered_share double, longest_repeat long"
    )
    return map_texts(df, text_col, make, schema, (id_col,))
