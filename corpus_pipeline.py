"""A training-corpus pipeline over ``documents``: five stages, each an operator of ``ledgerlens.llm``.

Stages take ``(spark, docs, sf_dir)``.  Each is written as Parquet and read again
as the next one's input.  All but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import language, line_templates, order_minhash, packing, pii
from ledgerlens.llm.common import col, table
from ledgerlens.session import materialize


def _aside(name: str) -> str:
    return f"__llm_in_{name}"


def _apart(docs: DataFrame, *results: str) -> DataFrame:
    """The table with columns renamed whose names an operator gives to its own results."""
    return docs.select(*[col(c).alias(_aside(c)) if c in results else col(c) for c in docs.columns])


def _again(made: DataFrame, docs: DataFrame, *results: str) -> DataFrame:
    """The columns of ``docs`` under their own names, with ``n_chars`` (where there is one) of the text as it is now."""
    fields = []
    for c in docs.columns:
        if c == "n_chars":
            fields.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            fields.append(col(_aside(c)).alias(c) if c in results else col(c))
    return made.select(*fields)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose two nearest codewords are about equally near, go."""
    results = ("lang_pred", "score", "ambiguous")
    apart = _apart(docs, *results)
    made = language.predict(apart, language.learn(apart), tuple(c for c in apart.columns if c != "text"), keep_text=True)
    return _again(made.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")), docs, *results)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines leave the texts; a document of which no word is left goes."""
    results = ("n_lines", "n_dropped")
    made = line_templates.drop_templates(_apart(docs, *results))
    word = F.col("text").rlike(r"\S")
    return _again(made.where((F.col("n_dropped") == 0) | word), docs, *results)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    gone = order_minhash.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("__llm_gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == F.col("__llm_gone"), "left_anti")


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind."""
    return pii.redact(docs, "text", "n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", mask_private),
    ("best_fit_packing", pack_sequences),
]

# Learned models, sketches and the linear program have no SQL; each stage is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result but the last is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
