"""Clocks: first activity, lifetime month, symmetric log, 0..12 spine.

Two clocks exist and are never mixed silently:

* ``sender`` — a user's first day is their first *sent* payment (profiles,
  Y, recency/frequency);
* ``both``   — first day over both orientations of the loop-free log (all
  graph metrics).

Start dates come from a grouped ``min`` (map-side partial aggregation, so a
user holding a third of all rows still spreads over every task).  The table of
start dates is stored once per log and joined back on ``user1``: the planner
broadcasts it when it is small, and beyond that both sides of the join are bare
shuffles, whose skewed partitions the runtime planner splits.  (A grouped
minimum directly under the join would forbid that.)  A window over
``partitionBy(user1)`` would put every row of a hot user into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlens.functions import lifetime_month
from ledgerlens.schema import DAYS_PER_MONTH, MAX_LIFETIME
from ledgerlens.session import materialize


def both_orientations(df: DataFrame, a: str = "user1", b: str = "user2", *rest: str) -> DataFrame:
    """Each row twice, as (a, b) and (b, a), from a single scan of ``df``.

    A ``UNION ALL`` of two projections would read the source twice; one
    ``explode`` over a two-element array reads it once.
    """
    pair = F.array(
        F.struct(F.col(a).alias("user1"), F.col(b).alias("user2")),
        F.struct(F.col(b).alias("user1"), F.col(a).alias("user2")),
    )
    return df.select(F.explode(pair).alias("_o"), *rest).select("_o.user1", "_o.user2", *rest)


def symmetric_log(payments: DataFrame) -> DataFrame:
    """E5: both orientations of every payment (UNION ALL semantics)."""
    return both_orientations(payments, "user1", "user2", "datetime")


def loop_free(payments: DataFrame) -> DataFrame:
    """Payments usable as graph edges: self-loops and null ids dropped."""
    return payments.where(
        F.col("user1").isNotNull()
        & F.col("user2").isNotNull()
        & (F.col("user1") != F.col("user2"))
        & F.col("datetime").isNotNull()
    )


def graph_log(payments: DataFrame) -> DataFrame:
    """Symmetric log for graph operators (loop-free)."""
    return symmetric_log(loop_free(payments))


def first_activity(rows: DataFrame) -> DataFrame:
    """D3: ``start_date`` = first ``datetime`` per ``user1``."""
    return rows.groupBy("user1").agg(F.min("datetime").alias("start_date"))


def with_clock(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Add ``start_date`` and ``lifetime`` to every row that has a user."""
    return rows.join(starts, "user1").withColumn("lifetime", lifetime_month("datetime", "start_date"))


def with_sender_starts(rows: DataFrame, payments: DataFrame) -> DataFrame:
    """Rows with their payer's ``start_date``; payments without a payer share one, as any payer's do."""
    of = sender_starts(payments).select(F.col("user1").alias("_user"), "start_date")
    return rows.join(of, F.col("user1").eqNullSafe(F.col("_user"))).drop("_user")


def sender_starts(payments: DataFrame) -> DataFrame:
    """Sender-clock first day per payer, stored once per log object.

    Every sender-clock operator on the same log reads the same stored table.
    """
    starts = payments.__dict__.get("_ledgerlens_sender_starts")
    if starts is None:
        starts = materialize(first_activity(payments.select("user1", "datetime")), "sender-starts")
        payments.__dict__["_ledgerlens_sender_starts"] = starts
    return starts


def keep(payments: DataFrame, name: str, table: DataFrame, *of: DataFrame) -> None:
    """Store ``table`` once per log (and dictionary ``of``) for the operators that ask ``kept`` for it."""
    payments.__dict__.setdefault("_ledgerlens_kept", {})[name] = (of, materialize(table, name))


def kept(payments: DataFrame, name: str, *of: DataFrame) -> DataFrame | None:
    made_of, table = payments.__dict__.get("_ledgerlens_kept", {}).get(name, ((), None))
    return table if len(made_of) == len(of) and all(a is b for a, b in zip(made_of, of)) else None


def sender_days(payments: DataFrame) -> DataFrame:
    """Payments per payer and calendar day, on the sender clock.

    Lifetime month and day offset depend only on the calendar day, so
    aggregate consumers count per (user, day) first: a payer with millions
    of payments joins the start dates with at most one row per active day.
    """
    daily = payments.groupBy("user1", F.to_date("datetime").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return with_sender_starts(daily, payments).select(
        "user1",
        "n",
        lifetime_month("day", "start_date").alias("lifetime"),
        F.datediff("day", "start_date").cast("bigint").alias("days"),
    )


def sender_clock(payments: DataFrame) -> DataFrame:
    """sender-clock rows with ``lifetime_days`` and ``days``."""
    rows = with_sender_starts(payments.select("user1", "user2", "datetime"), payments)
    return rows.withColumn("lifetime", lifetime_month("datetime", "start_date")).select(
        "user1",
        "user2",
        "datetime",
        "start_date",
        "lifetime",
        (F.col("lifetime") * DAYS_PER_MONTH).alias("lifetime_days"),
        F.datediff("datetime", "start_date").cast("bigint").alias("days"),
    )


def lifetime_spine(users: DataFrame) -> DataFrame:
    """Every user (one row per user expected) × months 0..12."""
    months = F.sequence(F.lit(0).cast("bigint"), F.lit(MAX_LIFETIME).cast("bigint"))
    return users.select("user1", F.explode(months).alias("lifetime"))


def sender_spine(payments: DataFrame) -> DataFrame:
    """E8 on the sender clock; payments without a payer belong to no panel."""
    return lifetime_spine(sender_starts(payments).where(F.col("user1").isNotNull()))


def dual_clock(payments: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """both parties' symmetric-clock month per symmetric row.

    ``starts`` are the symmetric-clock first days (computed here if not
    given).  Keeps rows whose ``user1_lifetime`` is at most 12.
    """
    rows = graph_log(payments)
    starts = materialize(first_activity(rows), "starts") if starts is None else starts
    s1 = starts.select("user1", F.col("start_date").alias("user1_start_date"))
    s2 = starts.select(F.col("user1").alias("user2"), F.col("start_date").alias("user2_start_date"))
    out = rows.join(s1, "user1").join(s2, "user2")
    out = out.select(
        "user1",
        "user2",
        "datetime",
        "user1_start_date",
        lifetime_month("datetime", "user1_start_date").alias("user1_lifetime"),
        "user2_start_date",
        lifetime_month("datetime", "user2_start_date").alias("user2_lifetime"),
    )
    return out.where(F.col("user1_lifetime") <= MAX_LIFETIME)


def running_window() -> WindowSpec:
    """Running frame over the 13-row per-user panel (bounded partition size)."""
    return (
        Window.partitionBy("user1")
        .orderBy("lifetime")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
