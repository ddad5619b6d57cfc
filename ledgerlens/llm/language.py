"""Operator 5: language identification by error-correcting output codes.

Every language gets a codeword; one binary n-gram classifier predicts each bit
(languages whose word has the bit against those without it, log-odds of hashed
character n-grams).  Decoding adds a loss for each bit, weighted by how well
that bit separates the languages, and takes the codeword of least loss.  When
the runner-up is nearly as good, the prediction is flagged.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import col, map_texts

#: hashed n-grams; with the number of languages it bounds the model
BUCKETS = 1 << 13
#: labelled documents of a language that are learned from (about; chosen by a hash of the id)
PER_LANGUAGE = 4000
#: languages of at most so many letters get the exhaustive code; more get random words
EXHAUSTIVE = 6
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Buckets of a text's 2- and 3-character n-grams, in lower case with non-letters as blanks."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = np.where((c < 128) & ((c < 97) | (c > 122)), 32, c)
    c = np.r_[np.uint64(32), c, np.uint64(32)]
    two = c[:-1] * np.uint64(1_000_003) + c[1:]
    three = two[:-1] * np.uint64(1_000_003) + c[2:]
    both = np.r_[two, three + np.uint64(1 << 40)] * np.uint64(0x9E3779B97F4A7C15)
    return (both >> np.uint64(64 - 13)).astype(np.int64)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A k x bits matrix of -1 and 1, rows far apart and no two columns alike."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= EXHAUSTIVE:
        columns = [(1, *x) for x in itertools.product((1, -1), repeat=k - 1) if -1 in x]
        return np.array(columns, float).T
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(200):
        m = rng.choice((-1.0, 1.0), (k, int(np.ceil(10 * np.log2(k)))))
        m = m[:, (m.min(0) < 0) & (m.max(0) > 0)]
        apart = (m.shape[1] - np.where(np.eye(k) > 0, -m.shape[1], m @ m.T).max()) / 2
        if apart > far:
            best, far = m, apart
    return best


class Model:
    """Codewords, one weight vector per bit, and the bits' weights in decoding."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        if not languages:
            return
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        bits = []
        for m in self.code.T:
            if (m < 0).any():
                bits.append(np.log(share[m > 0].mean(0)) - np.log(share[m < 0].mean(0)))
            else:
                bits.append(np.zeros(counts.shape[1]))
        self.bits = np.array(bits).T.astype(np.float32)
        # how far each bit's mean odds keep the two sides apart, at its worst language
        worst = (self.code * (share @ self.bits)).min(0)
        self.trust = np.maximum(worst, 0.01) / np.maximum(worst, 0.01).mean()

    def decode(self, odds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword of each row, its score, and how far the runner-up's score is."""
        z = np.clip(odds / np.sqrt(np.maximum(n, 1))[:, None], -30, 30)
        loss = (np.logaddexp(0, -z[:, None, :] * self.code[None]) * self.trust).sum(2)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        ranked = np.sort(p, 1)
        margin = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0)
        return p.argmax(1), ranked[:, -1], margin


def held_out(id_col: str) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def learn(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE
) -> Model:
    """Fit on labelled documents outside the held-out quarter, about ``per_language`` of each.

    Which ones is decided by a hash of the id, so the choice does not depend on
    partitions.  Only (language, bucket) sums reach the driver.
    """
    usable = df.where(~held_out(id_col) & col(lang_col).isNotNull() & col(text_col).isNotNull()).select(
        col(id_col).alias("__llm_id"), col(text_col).alias("__llm_doc"), col(lang_col).alias("__llm_lang")
    )
    sizes = usable.groupBy("__llm_lang").count()
    draw = F.pmod(F.xxhash64("__llm_id"), F.lit(1_000_000))
    # one row per language
    sample = usable.join(F.broadcast(sizes), "__llm_lang").where(
        draw * F.col("count") < F.lit(1_000_000 * per_language).cast("long")
    )

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                row += np.bincount(grams(text), minlength=BUCKETS)
        for lang, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(row[at])], names=["lang", "bucket", "n"])

    parts = sample.select("__llm_lang", "__llm_doc").mapInArrow(add_up, "lang string, bucket long, n long")
    rows = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    for i, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        counts[i, own["bucket"]] = own["n"]
    return Model(languages, counts)


def predict(
    df: DataFrame,
    model: Model,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    ambiguous_below: float = 0.05,
    keep_text: bool = False,
) -> DataFrame:
    """Language of every whole text: ``lang_pred``, ``score`` (0 to 1), ``ambiguous``.

    Only the text is read.  A text that is null or holds no letter is ``und``
    with score 0, and so is every text when nothing was learned.
    """
    languages = np.array(model.languages, dtype=object)

    def make():
        def work(texts):
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            unclear = [False] * len(texts)
            rows = [i for i, t in enumerate(texts) if t and len(languages) and any(map(str.isalpha, t))]
            if rows:
                counts = np.array([np.bincount(grams(texts[i]), minlength=BUCKETS) for i in rows], np.float32)
                best, p, margin = model.decode(counts @ model.bits, counts.sum(1))
                for i, b, s, m in zip(rows, best, p.tolist(), margin):
                    pred[i], score[i], unclear[i] = languages[b], s, bool(m < ambiguous_below)
            return None, [*([texts] if keep_text else []), pred, score, unclear]

        return work

    text = f"`{text_col}` string, " if keep_text else ""
    return map_texts(df, text_col, make, text + "lang_pred string, score double, ambiguous boolean", keep)


def identify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE
) -> DataFrame:
    """Learn from the table's labels and predict all of its documents.

    Returns the id, ``held_out``, ``lang_pred``, ``score``, ``ambiguous``.  Repeated
    rows get the same answer; an empty table gives an empty result.
    """
    model = learn(df, id_col, text_col, lang_col, per_language)
    made = predict(df, model, (id_col,), text_col)
    return made.select(col(id_col), held_out(id_col).alias("held_out"), "lang_pred", "score", "ambiguous")
