"""Spending profiles D1-D9 (sender clock).

Counts are grouped aggregates; shares need each user's (or user-month's)
total, taken from a window over the already-aggregated rows — at most ten
categories per user or user-month, so the window partitions are bounded.
Pivots use the fixed category list, so the output width never depends on
the data and no extra job is spent discovering pivot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import lifetime_month, round_share
from ledgerlens.operators.clock import kept, running_window, sender_spine, with_sender_starts
from ledgerlens.operators.text import category_counts, payments_with_category
from ledgerlens.schema import MAX_LIFETIME, PROFILE_COLUMNS


def category_share(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per user and category — count and share of the user's payments.

    Only ``transaction_type = 'payment'`` rows count.
    """
    paid = payments.where(F.col("transaction_type") == "payment")
    counts = (
        category_counts(payments, dictionary, ["user1"], rows=paid)
        .groupBy("user1", "category")
        .agg(F.sum("n").cast("bigint").alias("transaction_per_category"))
    )
    total = F.sum("transaction_per_category").over(Window.partitionBy("user1"))
    return counts.select(
        "user1", "category", "transaction_per_category", round_share("transaction_per_category", total).alias("ratio")
    )


def _pivot(df: DataFrame, keys: list[str], agg) -> DataFrame:
    return df.groupBy(*keys).pivot("category", PROFILE_COLUMNS).agg(agg(F.col("ratio")))


def spending_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per user, one share column per category (absent → null)."""
    return _pivot(category_share(payments, dictionary), ["user1"], F.avg)


def category_rows(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """D3 + D4: categorised payments on the sender clock."""
    rows = payments_with_category(payments, dictionary).select("user1", "category", "datetime")
    rows = with_sender_starts(rows, payments)
    return rows.withColumn("lifetime", lifetime_month("datetime", "start_date"))


def daily_category_counts(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Payments per payer, calendar day and category, with the sender-clock
    month.  Counted per (payer, day, description) before categorising and
    before the start-date join, so neither join sees raw payments."""
    daily = category_counts(payments, dictionary, ["user1", F.to_date("datetime").alias("day")])
    return with_sender_starts(daily, payments).select(
        "user1", "category", "n", lifetime_month("day", "start_date").alias("lifetime")
    )


def monthly_category_share(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per user, month 0..12 and category — count and share in that month.

    Every payment type counts here (unlike D1).
    """
    rows = daily_category_counts(payments, dictionary).where(F.col("lifetime") <= MAX_LIFETIME)
    counts = rows.groupBy("user1", "lifetime", "category").agg(
        F.sum("n").cast("bigint").alias("transaction_per_category_per_lifetime")
    )
    total = F.sum("transaction_per_category_per_lifetime").over(Window.partitionBy("user1", "lifetime"))
    return counts.select(
        "user1",
        "category",
        "lifetime",
        "transaction_per_category_per_lifetime",
        round_share("transaction_per_category_per_lifetime", total).alias("ratio"),
    )


def distinct_categories(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Categories that occur in months 0..12."""
    return monthly_category_share(payments, dictionary).select("category").distinct()


def dynamic_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per user and active month, one share column per category (absent → 0)."""
    stored = kept(payments, "dynamic-profile", dictionary)
    if stored is not None:
        return stored
    return _pivot(monthly_category_share(payments, dictionary), ["user1", "lifetime"], F.max).fillna(
        0.0, subset=PROFILE_COLUMNS
    )


def running_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Running average of each monthly share over the active months."""
    prof = dynamic_profile(payments, dictionary)
    w = running_window()
    return prof.select("user1", "lifetime", *[F.avg(c).over(w).alias(c) for c in PROFILE_COLUMNS])


def cumulative_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Share of each category among all payments so far, months 0..12.

    Two food and two activity payments out of four so far give 0.5 / 0.5.
    Months without payments carry the previous shares; before a user's first
    dated payment the shares are null.
    """
    rows = daily_category_counts(payments, dictionary).where(F.col("lifetime") <= MAX_LIFETIME)
    counts = rows.groupBy("user1", "lifetime").pivot("category", PROFILE_COLUMNS).agg(F.sum("n"))
    panel = sender_spine(payments).join(counts, ["user1", "lifetime"], "left")
    w = running_window()
    running = panel.select(
        "user1", "lifetime", *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(w).alias(c) for c in PROFILE_COLUMNS]
    )
    total = sum((F.col(c) for c in PROFILE_COLUMNS), F.lit(0))
    return running.select(
        "user1", "lifetime", *[F.try_divide(F.col(c), total).alias(c) for c in PROFILE_COLUMNS]
    )
