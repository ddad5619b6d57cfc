"""Operator 8: packing token sequences by a configuration linear program.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (at most ``capacity`` numbers, whatever the input) reaches the
driver.  There the covering program over configurations (multisets of length classes
that fit one sequence) is solved by multiplicative weights until every class is
covered: classes that are covered too little gain weight, and a knapsack dynamic
program prices the best configuration for the weights.  Rounding takes whole
copies of configurations and gives their slots real lengths; what does not fill
a sequence that way is placed best-fit decreasing, on counts.  The plan maps the r-th
piece of a length to its sequence and offset; pieces are ranked and mapped by
Spark, hot lengths in parts.
"""

from __future__ import annotations

import bisect
import gc
import math
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.bpe_codec import encode_parts
from ledgerlens.llm.common import col, map_texts
from ledgerlens.llm.vocabulary import Known, byte_alphabet, chunks, share, vocabulary
from ledgerlens.session import materialize

CAPACITY = 4096
#: id that ends a document
END = 1
#: priced configurations after which the step of the program grows
ROUNDS = 160
#: classes of lengths that the configurations are priced in, at most about twice so many
CLASSES = 512
#: share of a sequence that a configuration made of real lengths may leave empty
SPARE = 0.00025
#: times that the program is solved, each for the pieces that the one before left
PASSES = 2
#: pieces of one length that are ranked together
RANK_ROWS = 50_000
#: chunks, and pre-tokens, remembered by a worker, in each of two generations
REMEMBERED = 600_000


class Encoder:
    """Ids of whole texts by the tokenizers library, word by word.

    No pre-token of the vocabulary spans white space, so a text's ids are its
    chunks' ids one after the other, and a chunk's ids are its pre-tokens'.
    The library's model merges a pre-token the first time it is met; chunks and
    pre-tokens met before are looked up.
    """

    def __init__(self, data: bytes):
        gc.set_threshold(100_000, 50, 100)
        self.voc = vocabulary(data)
        self.merge = Tokenizer.from_str(data.decode()).model.tokenize
        self.letters = dict(enumerate(byte_alphabet()))
        self.words = Known(REMEMBERED, self.word)
        self.chunks = Known(REMEMBERED, self.chunk)

    def word(self, word: str) -> bytes:
        """Ids of a pre-token, which the model takes as one printable letter per UTF-8 byte."""
        if not word.isascii() or not word.isprintable():
            word = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merge(word)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a run without white space; a special string in it is its own id."""
        parts = encode_parts(chunk, self.voc)
        return b"".join([self.words[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in parts])

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Each document's ids and the end id, as little-endian unsigned 32-bit numbers."""
        get = self.chunks.__getitem__
        end = END.to_bytes(4, "little")
        return [b"".join(map(get, chunks(t or ""))) + end for t in texts]


_encoders: dict[int, Encoder] = {}


def pieces(df: DataFrame, vocab_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    data = share(df.sparkSession, vocab_path)

    def make():
        key = zlib.crc32(data.value)
        encoder = _encoders.get(key) or _encoders.setdefault(key, Encoder(data.value))

        def work(texts):
            take, piece, start, length, crc = [], [], [], [], []
            for i, raw in enumerate(encoder.ids(texts)):
                n = len(raw) // 4
                for k, at in enumerate(range(0, n, capacity)):
                    part = raw[4 * at : 4 * (at + capacity)]
                    take.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            return take, [piece, start, length, crc]

        return work

    return map_texts(df, text_col, make, "piece int, start long, length long, ids_crc32 long", (id_col,))


def price(worth: np.ndarray, capacity: int) -> Counter:
    """The configuration of greatest worth that fits: knapsack by dynamic programming over used tokens.

    ``worth[l]`` is what one piece of length l adds; 0 where there is none.
    """
    have = np.flatnonzero(worth > 0)
    best, chosen = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    value = worth[have]
    upto = np.searchsorted(have, np.arange(capacity + 1), side="right")
    for c in range(have[0], capacity + 1):
        total = best[c - have[: upto[c]]] + value[: upto[c]]
        k = total.argmax()
        if total[k] > best[c - 1]:
            best[c], chosen[c] = total[k], have[k]
        else:
            best[c] = best[c - 1]
    config: Counter = Counter()
    c = capacity
    while c > 0:
        if chosen[c]:
            config[int(chosen[c])] += 1
            c -= int(chosen[c])
        else:
            c -= 1
    return config


def classes(need: np.ndarray, width: int) -> np.ndarray:
    """Pieces by class: class c holds the lengths above ``(c - 1) * width`` up to ``c * width``."""
    size = -(-(len(need) - 1) // width)
    return np.bincount(-(-np.arange(len(need)) // width), need, size + 1).astype(np.int64)


def fractional(need: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[Counter, float]]:
    """Configurations and multiplicities that cover ``need`` (pieces by length), all but less than one of each length.

    Multiplicative weights: each round prices a configuration for the present
    weights, uses it as far as one step of the scarcest of its lengths allows,
    and lowers the weights of the lengths by what they got.  ``rounds`` sets the
    step, which grows with every so many rounds, so the program ends covered.
    """
    have = np.flatnonzero(need)
    got = np.zeros(len(need))
    used: dict[tuple, float] = {}
    at = 0
    while True:
        step = 0.1 * (1 + at // max(rounds, 1))
        at += 1
        # a length's worth: its tokens, times how far it lags behind
        lag = np.exp(-3.0 * got[have] / need[have])
        worth = np.zeros(len(need))
        worth[have] = have * (0.25 + lag / lag.max())
        worth[have[need[have] - got[have] < 1]] = 0
        if not worth.any():
            break
        config = price(worth, capacity)
        # a configuration priced beyond what is left of a length takes what is left
        config = Counter({l: min(k, int(need[l] - got[l])) for l, k in config.items()})
        room = min((need[l] - got[l]) // k for l, k in config.items())
        times = min(room, max(1.0, np.floor(step * min(need[l] / k for l, k in config.items()))))
        for l, k in config.items():
            got[l] += k * times
        key = tuple(sorted(config.items()))
        used[key] = used.get(key, 0.0) + times
    return [(Counter(dict(k)), x) for k, x in used.items()]


def best_fit(need: Counter, capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing on counts: bins alike are one entry (pattern, number of bins)."""
    bins: dict[int, list[list]] = {}  # tokens left -> [pattern, count]
    rooms: list[int] = []  # sorted keys of bins

    def put(left: int, pattern: tuple, count: int) -> None:
        if left not in bins:
            bins[left] = []
            bisect.insort(rooms, left)
        bins[left].append([pattern, count])

    for length in sorted(need, reverse=True):
        count = need[length]
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fits = capacity // length
                full, rest = divmod(count, fits)
                if full:
                    put(capacity - fits * length, ((length, fits),), full)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            left = rooms[at]
            pattern, many = bins[left].pop()
            if not bins[left]:
                del bins[left]
                rooms.pop(at)
            fits = left // length
            full = min(many, count // fits)
            if full:
                put(left - fits * length, (*pattern, (length, fits)), full)
                count -= full * fits
                many -= full
            elif count:
                put(left - count * length, (*pattern, (length, count)), 1)
                count, many = 0, many - 1
            if many:
                put(left, pattern, many)
    return [(Counter(dict(p)), n) for entries in bins.values() for p, n in entries]


def rounded(plan: list[tuple[Counter, float]], rest: np.ndarray, capacity: int, width: int) -> list[tuple[Counter, int]]:
    """Whole configurations of real lengths for a plan in classes; what they hold is taken from ``rest``.

    A slot takes the longest piece left that its class and the room that the
    slots before it saved let in, so classes cost no room.  A sequence that ends
    more than ``SPARE`` of the capacity short is not made; its pieces stay.
    """
    made: list[tuple[Counter, int]] = []
    left = np.flatnonzero(rest).tolist()
    for config, x in sorted(plan, key=lambda c: -c[1]):
        slots = [c for c in sorted(config, reverse=True) for _ in range(config[c])]
        x = int(x)
        while x > 0:
            spare = capacity - width * sum(slots)
            lengths: Counter = Counter()
            for c in slots:
                at = bisect.bisect_right(left, c * width + spare) - 1
                while at >= 0 and rest[left[at]] <= lengths[left[at]]:
                    at -= 1
                if at < 0:
                    break
                lengths[left[at]] += 1
                spare += c * width - left[at]
            lengths = +lengths
            if spare > SPARE * capacity or sum(lengths.values()) < len(slots):
                break
            times = min(x, min(int(rest[l]) // k for l, k in lengths.items()))
            made.append((lengths, times))
            x -= times
            for l, k in lengths.items():
                rest[l] -= k * times
                if not rest[l]:
                    left.remove(l)
    return made


def solve(need: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Counter, int]]:
    """Whole configurations that hold exactly the pieces of the histogram."""
    rest = need.astype(np.int64).copy()
    # a divisor of the capacity, so full classes are full sequences
    width = math.gcd(capacity, max(1, capacity // CLASSES))
    plan: list[tuple[Counter, int]] = []
    for _ in range(PASSES):
        plan += rounded(fractional(classes(rest, width), capacity // width, rounds), rest, capacity, width)
    return plan + best_fit(Counter({int(l): int(rest[l]) for l in np.flatnonzero(rest)}), capacity)


def placement(plan: list[tuple[Counter, int]], capacity: int) -> dict[int, np.ndarray]:
    """For each length its slots in order of rank: first rank, first sequence, pieces of it a sequence, first offset."""
    out: dict[int, list] = {}
    ranks: Counter = Counter()
    sequence = 0
    for config, times in plan:
        at = 0
        for length in sorted(config, reverse=True):
            k = config[length]
            out.setdefault(length, []).append((ranks[length], sequence, k, at))
            ranks[length] += k * times
            at += k * length
        sequence += times
    return {l: np.array(rows, np.int64) for l, rows in out.items()}


def place(made: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, rounds: int = ROUNDS, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    spark = made.sparkSession
    stored = materialize(made.withColumn("__llm_row", F.monotonically_increasing_id()), "pieces")
    sizes = stored.groupBy("length").count().collect()  # at most capacity rows
    need = np.zeros(capacity + 1, np.int64)
    for length, n in sizes:
        need[length] = n
    slots = placement(solve(need, capacity, rounds), capacity) if need.any() else {}
    # the plan's size depends on the rounds and the histogram, not on the rows
    plan = spark.sparkContext.broadcast(slots)
    parts = spark.createDataFrame([(int(l), max(1, -(-int(n) // rank_rows))) for l, n in sizes], "length long, __llm_parts int")
    salted = stored.join(F.broadcast(parts), "length").withColumn(
        "__llm_salt", F.pmod(F.xxhash64("__llm_row"), F.col("__llm_parts")).cast("int")
    )
    before = Window.partitionBy("length").orderBy("__llm_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy("length", "__llm_salt")
        .agg(F.count(F.lit(1)).alias("__llm_n"))
        .select("length", "__llm_salt", F.coalesce(F.sum("__llm_n").over(before), F.lit(0)).alias("__llm_start"))
    )
    local = Window.partitionBy("length", "__llm_salt").orderBy("__llm_row")
    fields = ["piece", "start", "length", "ids_crc32"]
    ranked = (
        salted.withColumn("__llm_in", F.row_number().over(local) - 1)
        .join(starts, ["length", "__llm_salt"])
        .select(col(id_col), *fields, (F.col("__llm_start") + F.col("__llm_in")).alias("__llm_rank"))
    )
    schema = ranked.drop("__llm_rank").schema.add("sequence_id", "long").add("offset", "long")

    def assign(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__llm_rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for l in np.unique(length):
                mine = np.flatnonzero(length == l)
                table = plan.value[int(l)]
                row = table[np.searchsorted(table[:, 0], rank[mine], side="right") - 1]
                inside = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + inside // row[:, 2]
                offset[mine] = row[:, 3] + inside % row[:, 2] * l
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*schema.names]
            )

    return ranked.mapInArrow(assign, schema)


def pack(
    df: DataFrame,
    vocab_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens for all documents.

    One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``.  A null or empty text is the end id alone.
    Repeated rows are pieces of their own; an empty table gives an empty
    result; extra columns are not read.
    """
    return place(pieces(df, vocab_path, capacity, id_col, text_col), id_col, capacity, rounds)
