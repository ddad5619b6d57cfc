"""Public byte-pair vocabularies: merge ranks by pair of ids, shared by operators 6, 8 and 9.

The file's bytes (a few MB, whatever the input) travel as a broadcast, so no
executor needs the path.  A worker parses them once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from pathlib import Path

import regex
from pyspark.sql import SparkSession
from tokenizers import Regex, normalizers

# Fixed value: the pre-token pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space as the tokenizers' patterns see it.
SPACE = "\t-\r \x85\xa0  -     　"
# str.split() also cuts at these four, which are no white space to the tokenizers.
SPLIT_ONLY = re.compile("[\x1c-\x1f]")
CHUNK = re.compile(f"[^{SPACE}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a BPE file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        #: pair of ids (left << 32 | right) -> rank; made: rank -> id of the merged symbol
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(self.ids[a] << 32 | self.ids[b], r)
            self.made.append(self.ids[a + b])
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token: dict[int, str] = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_alphabet()
        self.byte_id = [self.ids[c] for c in letters]
        self.last_byte_id = [self.ids[c + self.suffix] for c in letters]

    def symbols(self, word: str) -> list[int]:
        """A pre-token's first symbols: one per UTF-8 byte, the last with the word-end mark."""
        raw = word.encode("utf-8", "surrogatepass")
        out = [self.byte_id[b] for b in raw]
        if self.suffix:
            out[-1] = self.last_byte_id[raw[-1]]
        return out


@functools.lru_cache(maxsize=4)
def _parsed(digest: bytes, holder: "_Bytes") -> Vocabulary:
    return Vocabulary(holder.data)


class _Bytes:
    """Bytes that compare equal, so that the cache is keyed by the digest alone."""

    def __init__(self, data: bytes):
        self.data = data

    def __eq__(self, other):
        return isinstance(other, _Bytes)

    def __hash__(self):
        return 0


def vocabulary(data: bytes) -> Vocabulary:
    return _parsed(hashlib.sha256(data).digest(), _Bytes(data))


class Memo:
    """A bounded table of what a worker has worked out, in two generations.

    When the younger is full it becomes the older one; what is asked for again
    moves up, so frequent keys stay and rare ones go.
    """

    def __init__(self, limit: int):
        self.limit, self.known, self.older = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Keys to work out; the caller adds them to ``known``, which then holds all of ``keys``."""
        lack = keys.difference(self.known)
        fresh = [k for k in lack if k not in self.older]
        if len(self.known) + len(lack) > self.limit:
            fresh_set = set(fresh)
            self.known, self.older = {}, self.known | {k: self.older[k] for k in lack if k not in fresh_set}
            lack = keys
        self.known.update((k, self.older[k]) for k in lack if k in self.older)
        return fresh


class Known(dict):
    """A bounded table that works out what it lacks when asked, in two generations like :class:`Memo`."""

    def __init__(self, limit: int, make):
        super().__init__()
        self.limit, self.make, self.older = limit, make, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def share(spark: SparkSession, path: str):
    """Broadcast a vocabulary file (its size does not depend on the input)."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


# Both patterns run over a shadow text, in which λ stands for any letter beyond ASCII, ² for a number,
# an ideographic space for white space and ¤ for the rest.
_byte = regex.compile(BYTE_PATTERN)
# The word vocabulary's pre-token pattern ('s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+).
_word = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Zλ]+|[0-9²]|[^a-zA-Zλ0-9²]+")


_library_normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
# Letters up to here are composed already, and the library and Python agree on their lower case.
_composed = re.compile("[\x00-\u024f]*").fullmatch


class Classes(dict):
    """A table for ``str.translate``: code points beyond ASCII to a stand-in of their class.

    Which are letters, numbers and white space is asked of the tokenizers library, whose
    Unicode tables are neither Python's nor those of the regex package; a block of
    code points is looked up when one of them is first met.
    """

    _kinds = [(normalizers.Replace(Regex(p), ""), s) for p, s in ((r"\p{L}", "λ"), (r"\p{N}", "²"), (r"\s", "\u3000"))]

    def __missing__(self, point: int) -> str:
        first = point & ~0xFF
        # halves of surrogate pairs are no characters, and stand for themselves as symbols
        block = [chr(c) for c in range(max(first, 0x80), first + 0x100) if not 0xD800 <= c <= 0xDFFF]
        found = dict.fromkeys(range(first, first + 0x100), "¤")
        found.update((c, chr(c)) for c in range(first, first + 0x100) if c < 0x80)
        for pattern, stand_in in self._kinds:
            left = set(pattern.normalize_str("".join(block)))
            found.update((ord(c), stand_in) for c in block if c not in left)
        self.update(found)
        return self[point]


CLASSES = Classes()


def normal(chunk: str) -> str:
    """NFC, then lower case letter by letter, as the library does it."""
    return chunk.lower() if _composed(chunk) else _library_normal.normalize_str(chunk)


def byte_pieces(text: str) -> list[str]:
    """Pre-tokens of a text, for the byte-level vocabulary."""
    if text.isascii():
        return _byte.findall(text)
    return [text[m.start() : m.end()] for m in _byte.finditer(text.translate(CLASSES))]


def word_pieces(chunk: str) -> list[str]:
    """Pre-tokens of a chunk without white space, for the lower-case word vocabulary."""
    low = normal(chunk)
    if low.isascii():
        return [low] if low.isalpha() else _word.findall(low)
    return [low[m.start() : m.end()] for m in _word.finditer(low.translate(CLASSES))]


def chunks(text: str) -> list[str]:
    """A text's maximal runs without white space."""
    return CHUNK.findall(text) if SPLIT_ONLY.search(text) else text.split()
