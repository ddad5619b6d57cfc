"""Registered queries of the operators, over whole tables and whole texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe_codec,
    centroids,
    cover_tree,
    hard_negatives,
    language,
    line_templates,
    mixing,
    order_minhash,
    packing,
    pii,
    repetition,
    shards,
    token_count,
)
from ledgerlens.llm.common import table


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_templates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the digests are taken before the exchange, so that no text is shuffled
    slim = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shards.shuffle_into_shards(slim, 16).withColumn("grown_shard", F.lit(None).cast("int"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the number of distances computed depends on the pivots, so it is no part of the result
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("n_checked")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_cover_tree,
        op2_order_minhash,
        op3_line_templates,
        op4_pii,
        op5_language,
        op6_token_count,
        op7_repetition,
        op8_packing,
        op9_bpe_codec,
        op10_shards,
        op11_mixing,
        op12_centroids,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op3_line_templates": line_templates.SQL,
    "op12_centroids": centroids.sql(),
    "op13_hard_negatives": hard_negatives.SQL,
}
