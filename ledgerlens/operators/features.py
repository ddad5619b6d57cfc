"""Model inputs F1-F13: Y, recency/frequency, and the four feature panels.

All panels are keyed by (user1, lifetime) with 13 rows per user; the only
windows are running frames over those 13 rows.  Joins between panels share
the key, so each one is a single co-partitioned shuffle join (or a runtime
broadcast when one side is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.clock import dual_clock, keep, kept, running_window, sender_days, sender_spine, sender_starts
from ledgerlens.operators.graph import VIA_ROWS, Cut, PaymentGraph, cum_friends, cum_fof, cum_triangles, fof_new, graph_of, in_slices
from ledgerlens.operators.profile import dynamic_profile, running_profile
from ledgerlens.operators.rank import page_rank
from ledgerlens.schema import DAYS_PER_MONTH, MAX_LIFETIME, PROFILE_COLUMNS
from ledgerlens.session import materialize


def first_year_txn(payments: DataFrame) -> DataFrame:
    """F1 (Y): payments sent in months 0..12 of the sender clock."""
    monthly = kept(payments, "rf-monthly")
    if monthly is not None:
        return monthly.groupBy("user1").agg(F.sum("num_txn").cast("bigint").alias("num_transaction"))
    days = sender_days(payments).where(F.col("lifetime") <= MAX_LIFETIME)
    return days.groupBy("user1").agg(F.sum("n").cast("bigint").alias("num_transaction"))


def rf_monthly(payments: DataFrame) -> DataFrame:
    """per active month — last active day and number of payments."""
    stored = kept(payments, "rf-monthly")
    if stored is not None:
        return stored
    days = sender_days(payments).where(F.col("lifetime") <= MAX_LIFETIME)
    return days.groupBy("user1", "lifetime").agg(
        F.max("days").alias("latest_txn"), F.sum("n").cast("bigint").alias("num_txn")
    ).select(
        "user1",
        "lifetime",
        (F.col("lifetime") * DAYS_PER_MONTH).alias("lifetime_days"),
        "latest_txn",
        "num_txn",
    )


def keep_monthly(payments: DataFrame, dictionary: DataFrame) -> None:
    """Store F3 and D7 of a log that several models are built on: they are the only reads of all its payments."""
    keep(payments, "rf-monthly", rf_monthly(payments))
    keep(payments, "dynamic-profile", dynamic_profile(payments, dictionary), dictionary)


def rf_panel(payments: DataFrame) -> DataFrame:
    """F3 densified to months 0..12 (nulls where inactive)."""
    spine = sender_spine(payments)
    monthly = rf_monthly(payments).drop("lifetime_days")
    return spine.join(monthly, ["user1", "lifetime"], "left").select(
        "user1",
        "lifetime",
        (F.col("lifetime") * DAYS_PER_MONTH).alias("lifetime_days"),
        "latest_txn",
        "num_txn",
    )


def rf_model(payments: DataFrame) -> DataFrame:
    """F5 + F6: frequency and recency per month.

    frequency = payments so far / lifetime_days (0 in month 0);
    recency   = lifetime_days − last active day so far.
    """
    w = running_window()
    panel = rf_panel(payments)
    return panel.select(
        "user1",
        "lifetime",
        "lifetime_days",
        F.coalesce(
            F.try_divide(F.sum("num_txn").over(w).cast("double"), F.col("lifetime_days").cast("double")),
            F.lit(0.0),
        ).alias("frequency"),
        (F.col("lifetime_days") - F.max("latest_txn").over(w)).cast("bigint").alias("recency"),
    )


def model1_input(payments: DataFrame) -> DataFrame:
    """recency/frequency features with Y."""
    return rf_model(payments).join(first_year_txn(payments), "user1").select(
        "user1", "lifetime", "frequency", "recency", "num_transaction"
    )


def model2_input(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """F8: monthly spending shares + recency/frequency (missing → 0), with Y."""
    prof = dynamic_profile(payments, dictionary)
    rf = rf_model(payments).select("user1", "lifetime", "frequency", "recency")
    merged = rf.join(prof, ["user1", "lifetime"], "full_outer").select(
        "user1",
        "lifetime",
        "frequency",
        "recency",
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in PROFILE_COLUMNS],
    )
    return merged.join(first_year_txn(payments), "user1")


def model3_input(payments: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """cumulative friends, friends-of-friends, triangles, PageRank and Y.

    Inner joins, so users who never send (no Y) drop out.
    """
    ranks = page_rank(payments) if ranks is None else ranks
    totals = {"num_friends": "cum_num_friends", "num_friends_of_friends": "cum_num_fnd_of_fnd", "num_triangles": "cum_num_triangles"}
    months = F.sequence(F.lit(0).cast("bigint"), F.lit(MAX_LIFETIME).cast("bigint"))
    # joined with a row per user, and spread over the months at the end
    return (
        cum_friends(payments, lists=True)
        .join(cum_fof(payments, lists=True), "user1")
        .join(cum_triangles(payments, lists=True), "user1")
        .join(first_year_txn(payments), "user1")
        .join(ranks.select("user1", F.col("PageRank").alias("page_rank")), "user1")
        .select("*", F.explode(months).alias("lifetime"))
        .select(
            "user1",
            "lifetime",
            *[F.col(total)[F.col("lifetime").cast("int")].alias(name) for name, total in totals.items()],
            "page_rank",
            "num_transaction",
        )
    )


def friend_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """each symmetric payment with the payee's running profile.

    The payee's month is on the payee's own clock; months in which the payee
    has no profile row drop (inner join), as in the source analysis.
    """
    rows = dual_clock(payments, graph_of(payments).starts).select(
        "user1", "user2", F.col("user1_lifetime").alias("lifetime"), "user2_lifetime"
    )
    prof = running_profile(payments, dictionary).select(
        F.col("user1").alias("user2"), F.col("lifetime").alias("user2_lifetime"), *PROFILE_COLUMNS
    )
    return rows.join(prof, ["user2", "user2_lifetime"]).select(
        "user1", "user2", "lifetime", *PROFILE_COLUMNS
    )


def model4_input(payments: DataFrame, dictionary: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """friend profiles joined to the network features and Y."""
    return friend_profile(payments, dictionary).join(model3_input(payments, ranks), ["user1", "lifetime"])


def profile_steps(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per contact, how its running profile (D8) changes from active month to active month.

    One row per user with at most 13 steps: the own month, 1 for the first step,
    and the change of each share.  Stored, so that a join with it can be split.
    """
    by_month = Window.partitionBy("user1").orderBy("lifetime")
    change = [(F.col(c) - F.coalesce(F.lag(c).over(by_month), F.lit(0.0))).alias(c) for c in PROFILE_COLUMNS]
    first = F.when(F.row_number().over(by_month) == 1, 1).otherwise(0).cast("bigint").alias("first")
    steps = running_profile(payments, dictionary).select("user1", F.col("lifetime").alias("own"), first, *change)
    packed = steps.groupBy("user1").agg(F.collect_list(F.struct("own", "first", *PROFILE_COLUMNS)).alias("steps"))
    return materialize(
        packed.join(sender_starts(payments), "user1").select(
            F.col("user1").alias("contact"), F.col("start_date").alias("contact_start"), "steps"
        ),
        "profile-steps",
    )


def with_steps(known: DataFrame, steps: DataFrame, g: PaymentGraph, task_rows: int = VIA_ROWS // 4, slices: int = 1) -> DataFrame:
    """``known`` (user1, contact, …) joined with the contacts' ``steps``, of which there are up to 13 each.

    The steps that come out are summed in the tasks that make them.  Two hops
    through a user make at most its degree squared rows of ``known``.  Where the
    tasks that the planner is sure to keep might get too many, the join is
    divided here; a contact known to more users than one task takes has them
    dealt by a hash, its list repeated.  ``known`` may be one of ``slices`` of the users.
    """
    spark = known.sparkSession
    _, pairs, made = g.through
    most = -(-(made + pairs) // slices)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    parts = -(-most // task_rows)
    if parts <= (min(shuffled, spark.sparkContext.defaultParallelism) if merged else shuffled):
        return known.join(steps, "contact")
    # at most ``parts`` contacts, since their bounds add up to ``most``
    wide = F.broadcast(g.wide(task_rows * slices).withColumnRenamed("user1", "contact"))
    slots = F.coalesce("_s", F.lit(1))
    known = known.join(wide, "contact", "left").withColumn("_salt", F.pmod(F.xxhash64("user1"), slots).cast("int")).drop("_s")
    steps = steps.join(wide, "contact", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), slots - 1))).drop("_s")
    keys = ["contact", "_salt"]
    parts = max(parts, shuffled)
    return known.repartition(parts, *keys).join(steps.repartition(parts, *keys), keys).drop("_salt")


def network_profile(payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """average spending profile of the contacts known by each month, as of that month's last day.

    hop 1 = friends first met by the month, hop 2 = new friends-of-friends
    reached by the month (E12).  Month m of a user ends 30·m days after the user's
    first day; of a contact's running profile (D8), on the contact's own sender
    clock, only months that have ended by that date enter, and the last active
    one of them counts.  So no later payment enters, and a contact who has not
    paid by then does not count.  One row per (user1, lifetime, hop) from the
    first month with such a contact on.

    Both clocks have 30-day months, so a contact's month j has ended by the end
    of the user's month m exactly if j <= m + floor((user's first day - contact's
    first day) / 30).  Each pair is therefore joined once, with the contact's
    list of changes, and a change counts from one month of the user on; the
    averages are running sums of changes over the at most 13 rows of a user and hop.
    """
    g = graph_of(payments)
    steps = profile_steps(payments, dictionary)
    slices = g.slices

    def make(cut: Cut) -> DataFrame:
        friends = cut(g.edges).select(
            "user1", F.col("user2").alias("contact"), F.col("lifetime").alias("since"), "start_date", F.lit(1).alias("hop")
        )
        fofs = fof_new(payments, keep_null=False, cut=cut, slices=slices).join(cut(g.starts), "user1")
        fofs = fofs.select("user1", F.col("friend_of_friend").alias("contact"), F.col("lifetime").alias("since"), "start_date", F.lit(2).alias("hop"))
        return _averages(friends.unionByName(fofs).where(F.col("since") <= MAX_LIFETIME), steps, g, slices)

    return in_slices(slices, make, "network-profile")


def _averages(known: DataFrame, steps: DataFrame, g: PaymentGraph, slices: int) -> DataFrame:
    """F13 of the users in ``known`` (user1, contact, since, start_date, hop), one of ``slices`` of them."""
    shift = F.floor(F.datediff("start_date", "contact_start") / F.lit(DAYS_PER_MONTH))
    changes = (
        with_steps(known, steps, g, slices=slices)
        .select("user1", "hop", "since", shift.alias("shift"), F.explode("steps").alias("step"))
        .select("user1", "hop", F.greatest(F.col("step.own") - F.col("shift"), F.col("since")).alias("lifetime"), "step")
        .where(F.col("lifetime") <= MAX_LIFETIME)
        .groupBy("user1", "hop", "lifetime")
        .agg(F.sum("step.first").alias("n"), *[F.sum(f"step.{c}").alias(c) for c in PROFILE_COLUMNS])
    )
    by_month = Window.partitionBy("user1", "hop").orderBy("lifetime")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("lifetime").over(by_month) - 1, F.lit(MAX_LIFETIME).cast("bigint"))
    return (
        changes.withColumn("until", until)
        .select("user1", "hop", "lifetime", "until", *[F.sum(c).over(so_far).alias(c) for c in ("n", *PROFILE_COLUMNS)])
        .select(
            "user1",
            F.explode(F.sequence("lifetime", "until")).alias("lifetime"),
            "hop",
            F.col("n").cast("bigint").alias("n_contacts"),
            *[(F.col(c) / F.col("n")).alias(c) for c in PROFILE_COLUMNS],
        )
    )
