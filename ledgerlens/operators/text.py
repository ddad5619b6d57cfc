"""Text & emoji operators C2-C17.

Classification runs once per *distinct* description (a grouped aggregate, so
a memo used by a third of all payments costs one row), by joining its words
and code points to the long dictionary, which is broadcast only after its
size has been checked.  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import (
    code_points,
    contains_emoji,
    emoji_only,
    extract_emojis,
    text_tokens,
)
from ledgerlens.schema import EMOJI_CATEGORIES, NOT_CLASSIFIED, TEXT_CATEGORIES, emoji_class
from ledgerlens.session import materialize, release
from ledgerlens.sources.dictionary import bounded

# Order key of a dictionary entry: text entries first, then category rank,
# then row; one bigint so it aggregates with ``min``.
_SRC_WEIGHT = 10**15
_RK_WEIGHT = 10**12
# Largest classified-description table broadcast to the payment log.
MAX_BROADCAST_DESCRIPTIONS = 1_000_000


def category_name(rk: str) -> F.Column:
    """Category name of a checking-order rank column (unknown → Not_classified)."""
    expr = F.lit(NOT_CLASSIFIED)
    for i, name in reversed(list(enumerate(TEXT_CATEGORIES))):
        expr = F.when(F.col(rk) == i, F.lit(name)).otherwise(expr)
    return expr


def token_category(dictionary: DataFrame) -> DataFrame:
    """C4 on the dictionary: each token's first category in checking order."""
    return dictionary.groupBy("token").agg(F.min("rk").alias("tok_rk"))


def description_tokens(payments: DataFrame) -> DataFrame:
    """Distinct words of every distinct description."""
    return (
        payments.select("description")
        .where(F.col("description").isNotNull())
        .distinct()
        .select("description", F.explode(F.array_distinct(text_tokens("description"))).alias("token"))
    )


def normalize_text(payments: DataFrame) -> DataFrame:
    """C2 as a query: description → position and word."""
    return (
        payments.select("description")
        .where(F.col("description").isNotNull())
        .distinct()
        .select("description", F.posexplode(text_tokens("description")).alias("pos", "token"))
        .select("description", F.col("pos").cast("bigint").alias("pos"), "token")
    )


def classify(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Winning category of every distinct description.

    A hit is a dictionary *entry* present in the text (a word among the
    description's words, or an emoji code point inside it when the text has
    any emoji).  Each hit counts for its token's first category; the category
    with most hits wins, ties going to the earliest hit in entry order.
    """
    dictionary = bounded(dictionary)
    cats = bounded(token_category(dictionary))
    # stored: the planner would move the emoji test below the distinct, to every payment
    descs = materialize(payments.select("description").where(F.col("description").isNotNull()).distinct(), "descriptions")
    words = descs.select("description", F.explode(F.array_distinct(text_tokens("description"))).alias("token"))
    chars = descs.where(contains_emoji("description")).select(
        "description", F.explode(F.array_distinct(code_points("description"))).alias("token")
    )
    entries = dictionary.select(
        "src",
        "token",
        (
            F.when(F.col("src") == "text", F.lit(0)).otherwise(F.lit(1)).cast("bigint") * _SRC_WEIGHT
            + F.col("rk").cast("bigint") * _RK_WEIGHT
            + F.col("pos").cast("bigint")
        ).alias("order_key"),
    )
    hits = words.join(entries.where(F.col("src") == "text"), "token").unionByName(
        chars.join(entries.where(F.col("src") == "emoji"), "token")
    )
    per_cat = (
        hits.join(cats, "token")
        .groupBy("description", "tok_rk")
        .agg(F.count(F.lit(1)).alias("hits"), F.min("order_key").alias("first_hit"))
    )
    # At most one row per category per description: a bounded window.
    best = Window.partitionBy("description").orderBy(F.col("hits").desc(), F.col("first_hit").asc())
    return (
        per_cat.withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") == 1)
        .select("description", category_name("tok_rk").alias("category"))
    )


def classified_side(
    payments: DataFrame, dictionary: DataFrame, max_broadcast: int = MAX_BROADCAST_DESCRIPTIONS
) -> DataFrame:
    """The classified table, ready to join on ``description``.

    Written once per (log, dictionary) and counted.  Within
    ``max_broadcast`` rows it carries a broadcast hint, so the payment side
    is never shuffled for the join; beyond that both sides shuffle by
    description and AQE splits hot descriptions.
    """
    memo = payments.__dict__.setdefault("_ledgerlens_classified", {})
    hit = memo.get(id(dictionary))
    if hit is not None and hit[0] is dictionary:
        return hit[1]
    classified = materialize(classify(payments, dictionary), "classified")
    small = classified.limit(max_broadcast + 1).count() <= max_broadcast
    side = F.broadcast(classified) if small else classified
    memo[id(dictionary)] = (dictionary, side, classified)
    return side


def release_classified(payments: DataFrame) -> None:
    """Remove what was stored of a log's classification, once its results are written."""
    for *_, classified in payments.__dict__.pop("_ledgerlens_classified", {}).values():
        release(classified)


def payments_with_category(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every payment with its description's category."""
    return payments.join(classified_side(payments, dictionary), "description", "left").select(
        *payments.columns, F.coalesce(F.col("category"), F.lit(NOT_CLASSIFIED)).alias("category")
    )


def category_counts(
    payments: DataFrame, dictionary: DataFrame, keys: list, rows: DataFrame | None = None
) -> DataFrame:
    """Payments per ``keys`` and category, counted before categorising.

    ``rows`` (default: the whole log) are first counted per keys and
    description with map-side combine, so the join with the classified table
    sees one row per distinct (keys, description) instead of one per payment.
    The classification itself is shared per log.
    """
    counted = (payments if rows is None else rows).groupBy(*keys, "description").agg(
        F.count(F.lit(1)).alias("n")
    )
    key_cols = [c for c in counted.columns if c not in ("description", "n")]
    return counted.join(classified_side(payments, dictionary), "description", "left").select(
        *key_cols, F.coalesce(F.col("category"), F.lit(NOT_CLASSIFIED)).alias("category"), "n"
    )


def contains_emoji_flag(payments: DataFrame) -> DataFrame:
    """Whether each distinct description contains an emoji."""
    return (
        payments.select("description")
        .where(F.col("description").isNotNull())
        .distinct()
        .select("description", contains_emoji("description").alias("has_emoji"))
    )


def emoji_only_flag(payments: DataFrame) -> DataFrame:
    """1 when the description is made of emoji only ('' counts)."""
    return payments.withColumn(
        "emoji_only",
        F.when(F.col("description").isNull(), F.lit(0)).otherwise(emoji_only("description")),
    )


def emoji_only_count(payments: DataFrame) -> DataFrame:
    """Number of emoji-only payments."""
    return emoji_only_flag(payments).agg(F.sum("emoji_only").cast("bigint").alias("sum_emoji_only"))


def emoji_only_share(payments: DataFrame) -> DataFrame:
    """Emoji-only payments as a share of all payments (computed)."""
    flags = emoji_only_flag(payments)
    return flags.agg(
        F.sum("emoji_only").cast("bigint").alias("sum_emoji_only"),
        F.count(F.lit(1)).alias("payments"),
    ).select(
        "sum_emoji_only",
        "payments",
        (F.col("sum_emoji_only") / F.col("payments")).alias("share"),
        (F.col("sum_emoji_only") * F.lit(100.0) / F.col("payments")).alias("share_pct"),
    )


def with_emojis(payments: DataFrame) -> DataFrame:
    """The emoji code points of each description, concatenated."""
    return payments.withColumn(
        "emoji", F.when(F.col("description").isNull(), F.lit("")).otherwise(extract_emojis("description"))
    )


def blank_to_null(payments: DataFrame) -> DataFrame:
    """C10 + C11: emoji column with '' turned into null."""
    return with_emojis(payments).withColumn("emoji", F.nullif(F.col("emoji"), F.lit("")))


def has_emoji_payments(payments: DataFrame) -> DataFrame:
    """Payments with at least one emoji."""
    return blank_to_null(payments).where(F.col("emoji").isNotNull())


def emoji_explode(payments: DataFrame) -> DataFrame:
    """One row per emoji occurrence."""
    return payments.select(
        "user1",
        "user2",
        "datetime",
        F.explode(F.regexp_extract_all(F.col("description"), F.lit(f"({emoji_class()})"), 1)).alias("emoji"),
    )


def emoji_frequency(payments: DataFrame) -> DataFrame:
    """C14: occurrences per emoji."""
    return emoji_explode(payments).groupBy("emoji").agg(F.count(F.lit(1)).alias("n"))


def top_emojis(payments: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most used emoji, ties by code point."""
    freq = emoji_frequency(payments).orderBy(F.col("n").desc(), F.col("emoji").asc()).limit(k)
    return freq


def emoji_category_counts(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Emoji occurrences per category (emoji dictionary only).

    Every category of the emoji dictionary plus ``Not_classified`` gets a
    row, zero where nothing matched.
    """
    emoji_cats = bounded(token_category(dictionary.where(F.col("src") == "emoji")))
    counts = (
        emoji_explode(payments)
        .join(emoji_cats.withColumnRenamed("token", "emoji"), "emoji", "left")
        .groupBy("tok_rk")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spark = payments.sparkSession
    names = EMOJI_CATEGORIES + [NOT_CLASSIFIED]
    domain = spark.createDataFrame(
        [(i if i < len(EMOJI_CATEGORIES) else None, i, n) for i, n in enumerate(names)],
        "tok_rk int, rk int, category string",
    )
    return F.broadcast(domain).join(counts, domain.tok_rk.eqNullSafe(counts.tok_rk), "left").select(
        "category", domain.rk.alias("rk"), F.coalesce(counts.n, F.lit(0)).cast("bigint").alias("n")
    )


def top_emoji_categories(payments: DataFrame, dictionary: DataFrame, k: int = 3) -> DataFrame:
    """C17: categories by emoji count (Not_classified left out), top ``k``."""
    return (
        emoji_category_counts(payments, dictionary)
        .where(F.col("category") != NOT_CLASSIFIED)
        .orderBy(F.col("n").desc(), F.col("rk").asc())
        .limit(k)
    )
