"""Social-graph operators E1-E22 on the symmetric clock.

Design points for scale:

* Everything starts from grouped aggregates (first payment per ordered pair,
  first day per user) that combine map-side, so a user or pair holding a
  third of the log never lands in one task as raw rows.
* Per-user panels (13 rows per user) are the only thing windowed by user.
* Triangles are enumerated once per triangle on edges oriented from lower
  to higher (degree, id); every node's out-degree is then O(sqrt(m)), which
  bounds the wedge join even around hubs (no all-pairs within a hub).
* Friends-of-friends pre-reduce both sides of the time-respecting self-join
  (right side to its first payment per pair, left side to the last payment
  per pair and month) before joining.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import lifetime_month
from ledgerlens.operators.clock import (
    both_orientations,
    first_activity,
    graph_log,
    loop_free,
    lifetime_spine,
    running_window,
    with_clock,
)
from ledgerlens.schema import MAX_LIFETIME
from ledgerlens.session import materialize

#: neighbours of a user on one side of a task of a join through that user
HUB_BLOCK = 1000
#: rows that one task makes of a join through users, at most on average
VIA_ROWS = 4_000_000
#: rows of a join through users whose shuffles are on disk at once: so many, or so many times the pairs if that is more
SLICE_ROWS = 64_000_000
SLICE_PAIRS = 4

#: a cut of rows with a ``user1``, see ``in_slices``
Cut = Callable[[DataFrame], DataFrame]


class PaymentGraph:
    """Intermediates shared by the graph operators of one payment log.

    First contacts, start dates and degrees are stored once per log, when an
    operator first needs them.  Joins with them therefore have bare shuffles on
    both sides, which the runtime planner can split for a hot user, and several
    operators of one query do not start from the log again.  The other
    properties are lazily built; within a query the planner sees identical
    subtrees and computes each exchange once.
    """

    def __init__(self, payments: DataFrame):
        self.payments = payments

    @cached_property
    def undirected(self) -> DataFrame:
        """First payment time per unordered pair ``a < b`` (either direction)."""
        first = (
            loop_free(self.payments)
            .groupBy(F.least("user1", "user2").alias("a"), F.greatest("user1", "user2").alias("b"))
            .agg(F.min("datetime").alias("datetime"))
        )
        return materialize(first, "pairs")

    @cached_property
    def pairs(self) -> DataFrame:
        """First payment time per ordered pair (both orientations share it)."""
        return both_orientations(self.undirected, "a", "b", "datetime")

    @cached_property
    def starts(self) -> DataFrame:
        """Symmetric-clock first day per user: from the pairs if they are stored, else straight from the log,
        whose partial minima need no shuffle of pairs."""
        if "undirected" in self.__dict__:
            return self.nodes.select("user1", "start_date")
        return materialize(first_activity(graph_log(self.payments)), "starts")

    @cached_property
    def nodes(self) -> DataFrame:
        """Friends and first day per user; the first day is that of the user's earliest pair."""
        facts = [F.count(F.lit(1)).alias("num_friends"), F.min("datetime").alias("start_date")]
        return materialize(self.pairs.groupBy("user1").agg(*facts), "degree")

    @cached_property
    def degree(self) -> DataFrame:
        return self.nodes.select("user1", "num_friends")

    @cached_property
    def through(self) -> tuple[int, int, int]:
        """Friends of the user with most, ordered pairs, and paths of two steps (a user's friends squared)."""
        d = F.col("num_friends")
        widest, pairs, made = self.degree.agg(F.max(d), F.sum(d), F.sum(d.cast("double") * d)).first()
        return widest or 0, pairs or 0, int(made or 0)

    @cached_property
    def slices(self) -> int:
        """In how many slices of the users a join through users is made, so that the disk holds a few times the pairs."""
        _, pairs, made = self.through
        return max(1, -(-made // max(SLICE_ROWS, SLICE_PAIRS * pairs)))

    def wide(self, task_rows: int) -> DataFrame:
        """Users with more than ``task_rows`` paths of one or two steps, and in how many parts ``_s`` those go; stored."""
        done = self.__dict__.setdefault("_wide", {})
        if task_rows not in done:
            steps = self.degree.select(F.col("user1").alias("user2"), (F.col("num_friends") + 1).alias("_n"))
            parts = self.pairs.join(steps, "user2").groupBy("user1").agg(F.ceil(F.sum("_n") / task_rows).cast("int").alias("_s"))
            done[task_rows] = materialize(parts.where(F.col("_s") > 1), "wide-users")
        return done[task_rows]

    @cached_property
    def spine(self) -> DataFrame:
        return lifetime_spine(self.starts)

    @cached_property
    def edges(self) -> DataFrame:
        """E16 rows: lifetime is monotone in datetime, so the first payment's
        month is the pair's first month; no raw row is joined."""
        return self.pairs.join(self.starts, "user1").select(
            "user1",
            "user2",
            "datetime",
            lifetime_month("datetime", "start_date").alias("lifetime"),
            "start_date",
        )

    @cached_property
    def met(self) -> DataFrame:
        return self.edges.select("user1", "user2", "lifetime")

    @cached_property
    def day_rows(self) -> DataFrame:
        """First and last payment per ordered pair and calendar day, with the
        month on user1's clock.  Aggregated per unordered pair and day before
        the orientations are emitted and the start dates joined, so a hub's
        payments reach the join as at most one row per pair and day."""
        clean = loop_free(self.payments)
        daily = clean.groupBy(
            F.least("user1", "user2").alias("a"),
            F.greatest("user1", "user2").alias("b"),
            F.to_date("datetime").alias("day"),
        ).agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
        return (
            both_orientations(daily, "a", "b", "day", "lo", "hi")
            .join(self.starts, "user1")
            .withColumn("lifetime", lifetime_month("day", "start_date"))
        )

    @cached_property
    def pair_months(self) -> DataFrame:
        """First and last payment per ordered pair and month 0..12 of user1's clock, stored: E11 reads it twice."""
        months = (
            self.day_rows.where(F.col("lifetime") <= MAX_LIFETIME)
            .groupBy("user1", "user2", "lifetime")
            .agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"))
        )
        return materialize(months, "pair-months")

    @cached_property
    def rows(self) -> DataFrame:
        """Every symmetric row with its symmetric-clock month."""
        return with_clock(graph_log(self.payments), self.starts)


def graph_of(payments: DataFrame) -> PaymentGraph:
    """The shared context of ``payments`` (one per DataFrame object)."""
    g = payments.__dict__.get("_ledgerlens_graph")
    if g is None:
        g = PaymentGraph(payments)
        payments.__dict__["_ledgerlens_graph"] = g
    return g


# --------------------------------------------------------------------------
# Adjacency
# --------------------------------------------------------------------------
def friend_pairs(payments: DataFrame) -> DataFrame:
    """Distinct ordered pairs of the symmetric, loop-free graph."""
    return graph_of(payments).pairs.select("user1", "user2")


def friend_list(payments: DataFrame) -> DataFrame:
    """Adjacency in long form with each user's degree.

    One row per (user1, friend) rather than one array per user, so a hub's
    adjacency never has to fit in a single row or task.
    """
    g = graph_of(payments)
    return g.pairs.join(g.degree, "user1").select("user1", F.col("user2").alias("friend"), "num_friends")


def hub_grid(left: DataFrame, right: DataFrame, degree: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """``left`` (user1, via, …) and ``right`` (via, far, …) with ``_row`` and ``_col``, their place in a grid of blocks.

    A user with more than ``block`` neighbours has those of either side dealt to
    blocks by a hash; each pair of blocks becomes a key of its own, for which the
    rows of either side are repeated.  Users below that have one block.
    """
    grid = degree.select(F.col("user1").alias("via"), F.ceil(F.col("num_friends") / block).cast("int").alias("_g"))

    def deal(side: DataFrame, own: str, by: str, other: str) -> DataFrame:
        side = side.join(grid, "via").withColumn(own, F.pmod(F.xxhash64(by), F.col("_g")).cast("int"))
        return side.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_g") - 1))).drop("_g")

    return deal(left, "_row", "user1", "_col"), deal(right, "_col", "far", "_row")


def join_via(
    left: DataFrame, right: DataFrame, degree: DataFrame, block: int = HUB_BLOCK, task_rows: int = VIA_ROWS, slices: int = 1
) -> DataFrame:
    """Join ``left`` (user1, via, …) and ``right`` (via, far, …) on ``via``.

    ``degree`` is the stored table of neighbours per user.  Where one has more
    than ``block``, the sides meet in a grid, so no key has more than about
    ``block`` rows a side; without such a hub every user is one block, and the
    join is the plain one.  The sides are small beside what the join makes of
    them, by which it is divided here: the planner would judge by the sides, and
    the rows are aggregated in the tasks that make them.  ``left`` may be one of
    ``slices`` of the users.
    """
    d = F.col("num_friends")
    widest, made = degree.agg(F.max(d), F.sum(d.cast("double") * d)).first()
    made = (made or 0) / slices
    keys = ["via"]
    if (widest or 0) > block:
        left, right = hub_grid(left, right, degree, block)
        keys = ["via", "_row", "_col"]
    if made > task_rows:
        parts = max(int(-(-made // task_rows)), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        left, right = left.repartition(parts, *keys), right.repartition(parts, *keys)
    return left.join(right, keys).drop("_row", "_col")


def in_slices(slices: int, make: Callable[[Cut], DataFrame], tag: str) -> DataFrame:
    """The rows of ``make(cut)`` for ``slices`` slices of the users, where ``cut`` keeps the rows of a slice's ``user1``.

    Each slice is stored before the next one starts, and its shuffles are removed
    then, so the disk holds those of one slice at a time.  A single slice is not stored.
    """
    if slices == 1:
        return make(lambda rows: rows)
    # seeded, so that it is independent of other hashes of the user
    mark = F.pmod(F.xxhash64("user1", F.lit(slices)), F.lit(slices))
    stored = [materialize(make(lambda rows, k=k: rows.where(mark == k)), tag) for k in range(slices)]
    paths = [s.__dict__["_ledgerlens_path"] for s in stored]
    return stored[0].sparkSession.read.schema(stored[0].schema).parquet(*paths)


def _two_hops(payments: DataFrame, hub_block: int, task_rows: int, only: bool) -> DataFrame:
    """E3 (``only``: E4): the distinct ends of all paths of two steps, without those that are friends.

    The neighbours of a user travel as a list, not as a row each: once per friend,
    to the task that has all lists of that friend and makes the ends distinct.  For
    E4 a user's own list comes along, marked.  A user whose lists are too many for
    a task has their entries dealt by a hash.
    """
    g = graph_of(payments)
    widest, _, made = g.through
    pairs = friend_pairs(payments)
    left, right = pairs.select("user1", F.col("user2").alias("via")), pairs.select(F.col("user1").alias("via"), F.col("user2").alias("far"))
    keys = ["via"]
    if widest > hub_block:
        left, right = hub_grid(left, right, g.degree, hub_block)
        keys = ["via", "_row", "_col"]
    lists = materialize(right.groupBy(*keys).agg(F.collect_list("far").alias("fars")), "friend-lists")
    own = lists if keys == ["via"] else lists.where("_row = 0")
    own = own.select(F.col("via").alias("user1"), "fars", F.lit(True).alias("known"))
    # no user has more paths than its friends times the friends of the user with most
    wide = F.broadcast(g.wide(task_rows)) if widest * (widest + 1) > task_rows else None
    slices = g.slices
    parts = max(-(-made // (slices * task_rows)), int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def make(cut: Cut) -> DataFrame:
        a, b = cut(left), lists
        if made > task_rows:
            a, b = a.repartition(parts, *keys), b.repartition(parts, *keys)
        paths = a.join(b, keys).select("user1", "fars", F.lit(False).alias("known"))
        if only:
            paths = paths.unionByName(cut(own))
        by = ["user1"]
        if wide is not None:
            by = ["user1", "_salt"]
            whole = F.array(F.struct(F.lit(0).alias("_salt"), "fars"))
            dealt = F.transform(
                F.sequence(F.lit(0), F.col("_s") - 1),
                lambda i: F.struct(i.alias("_salt"), F.filter("fars", lambda far: F.pmod(F.xxhash64(far), F.col("_s")) == i).alias("fars")),
            )
            paths = paths.join(wide, "user1", "left").select("user1", "known", F.inline(F.when(F.col("_s").isNull(), whole).otherwise(dealt)))
        paths = paths.repartition(parts, *by) if made > task_rows else paths.repartition(*by)
        ends = paths.select(*by, "known", F.explode("fars").alias("two_hop"))
        ends = ends.groupBy(*by, "two_hop").agg(F.max("known").alias("known"))
        return (ends.where(~F.col("known")) if only else ends).select("user1", "two_hop")

    return in_slices(slices, make, "two-hops")


def two_hop(payments: DataFrame, hub_block: int = HUB_BLOCK, task_rows: int = VIA_ROWS) -> DataFrame:
    """Every user reachable over two hops (the user itself included)."""
    return _two_hops(payments, hub_block, task_rows, only=False)


def two_hop_only(payments: DataFrame, drop_self: bool = False, hub_block: int = HUB_BLOCK, task_rows: int = VIA_ROWS) -> DataFrame:
    """Two-hop users that are not direct friends (set difference)."""
    out = _two_hops(payments, hub_block, task_rows, only=True)
    if drop_self:
        out = out.where(F.col("user1") != F.col("two_hop"))
    return out


# --------------------------------------------------------------------------
# First contact per pair (E7, E16) and the spine
# --------------------------------------------------------------------------
def undirected_first(payments: DataFrame) -> DataFrame:
    return graph_of(payments).undirected


def pair_first(payments: DataFrame) -> DataFrame:
    return graph_of(payments).pairs


def first_edges(payments: DataFrame) -> DataFrame:
    """Per ordered pair — first datetime, its lifetime month, start date."""
    return graph_of(payments).edges


def first_met(payments: DataFrame) -> DataFrame:
    """First lifetime month in which each ordered pair transacted."""
    return graph_of(payments).met


def graph_spine(payments: DataFrame) -> DataFrame:
    """E8 on the symmetric clock: users of the loop-free graph × 0..12."""
    return graph_of(payments).spine


def both_clock_rows(payments: DataFrame) -> DataFrame:
    """E6 through the shared context."""
    return graph_of(payments).rows


def _count_on_spine(spine: DataFrame, events: DataFrame, name: str) -> DataFrame:
    return spine.join(_per_month(events, name), ["user1", "lifetime"], "left").select(
        "user1", "lifetime", F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    )


def _per_month(events: DataFrame, name: str) -> DataFrame:
    return (
        events.where(F.col("lifetime") <= MAX_LIFETIME)
        .groupBy("user1", "lifetime")
        .agg(F.count(F.lit(1)).alias(name))
    )


def _running_sum(panel: DataFrame, col: str, name: str) -> DataFrame:
    return panel.withColumn(name, F.sum(col).over(running_window()))


def _running_list(users: DataFrame, counts: DataFrame, col: str, name: str) -> DataFrame:
    """The running sums of ``col`` over months 0..12 as one list per user: panels then join with a row per user,
    not 13, and need no window."""
    zero = F.lit(0).cast(counts.schema[col].dataType)
    until = [F.coalesce(F.sum(F.when(F.col("lifetime") <= m, F.col(col))), zero) for m in range(MAX_LIFETIME + 1)]
    lists = counts.groupBy("user1").agg(*[u.alias(f"_{m}") for m, u in enumerate(until)])
    slots = F.array(*[F.coalesce(F.col(f"_{m}"), zero) for m in range(MAX_LIFETIME + 1)])
    return users.select("user1").join(lists, "user1", "left").select("user1", slots.alias(name))


# --------------------------------------------------------------------------
# Friends per month
# --------------------------------------------------------------------------
def new_friends(payments: DataFrame) -> DataFrame:
    """Friends first met in each month 0..12 (0 where none)."""
    g = graph_of(payments)
    return _count_on_spine(g.spine, g.met, "num_friends")


def cum_friends(payments: DataFrame, lists: bool = False) -> DataFrame:
    """Running total of friends per month (``lists``: one row per user with the 13 totals)."""
    if lists:
        g = graph_of(payments)
        return _running_list(g.starts, _per_month(g.met, "num_friends"), "num_friends", "cum_num_friends")
    return _running_sum(new_friends(payments), "num_friends", "cum_num_friends")


# --------------------------------------------------------------------------
# Friends of friends
# --------------------------------------------------------------------------
def _runner_up(pairs: DataFrame, starts: DataFrame) -> DataFrame:
    """Per user, the second-smallest first-contact time (ties count twice).

    A user's smallest is their start date.  The aggregate combines map-side, so a
    hub's contacts never meet in one task as raw rows.
    """
    first = starts.select("user1", F.col("start_date").alias("d1"))
    second = (
        pairs.join(first, "user1")
        .groupBy("user1", "d1")
        .agg(
            F.sum(F.when(F.col("datetime") == F.col("d1"), 1).otherwise(0)).alias("at_min"),
            F.min(F.when(F.col("datetime") > F.col("d1"), F.col("datetime"))).alias("above"),
        )
    )
    return second.select(
        F.col("user1").alias("via"),
        F.when(F.col("at_min") >= 2, F.col("d1")).otherwise(F.col("above")).alias("d2"),
    )


def fof_first_met(payments: DataFrame, keep_null: bool = True, hub_block: int = HUB_BLOCK) -> DataFrame:
    """First month (user1's clock) each friend-of-friend was reached.

    Time-respecting: the u–v payment must be no earlier than some v–w
    payment, w ≠ u.  The right side only needs v's first contact with each
    w; the left side only the last payment per (u, v, month), because a
    later payment reaches whatever an earlier one does, and those ≤ 13
    monthly values travel side by side in one row per (u, v).  The neighbours of a hub v
    meet in a grid of blocks (``join_via``).

    A later month's last payment is later, so the first month that reaches w is
    found by comparing w's time with up to 13 columns, without array functions.

    With ``keep_null`` the rows of u whose payment reached nobody form one
    group with a null ``friend_of_friend``, as a left outer join gives.  A
    u–v payment at time t reaches nobody iff v has at most one partner with
    first contact ≤ t (u itself always is one), i.e. iff v's second-smallest
    first-contact time is later than t.
    """
    matched = _reached(payments, keep_null, hub_block).groupBy("user1", "friend_of_friend").agg(F.min("lifetime").alias("lifetime"))
    return matched.unionByName(_unreached(payments)) if keep_null else matched


def _reached(payments: DataFrame, stored: bool, hub_block: int = HUB_BLOCK, cut: Cut | None = None, slices: int = 1) -> DataFrame:
    """E11 before its minimum: one row per (u, v, w) with the first month in which u reaches w through v.

    ``stored`` months are made once and read again by ``_unreached`` or for the other ``slices``, of
    which ``cut`` keeps one.
    """
    g = graph_of(payments)
    months = range(MAX_LIFETIME + 1)
    left = g.pair_months if stored or slices > 1 else g.day_rows.where(F.col("lifetime") <= MAX_LIFETIME)
    left = cut(left) if cut else left
    right = g.pairs.select(F.col("user1").alias("via"), F.col("user2").alias("far"), F.col("datetime").alias("first_dt"))
    # One row per (u, v), so the join on the middle user emits one row per
    # (u, v, w) instead of one per active month.
    per_pair = left.groupBy("user1", F.col("user2").alias("via")).agg(
        F.max("hi").alias("last"), *[F.max(F.when(F.col("lifetime") == m, F.col("hi"))).alias(f"hi{m}") for m in months]
    )
    reached = F.lit(None).cast("bigint")
    for m in reversed(months):
        reached = F.when(F.col(f"hi{m}") >= F.col("first_dt"), F.lit(m).cast("bigint")).otherwise(reached)
    return (
        join_via(per_pair, right, g.degree, hub_block, slices=slices)
        .where((F.col("far") != F.col("user1")) & (F.col("first_dt") <= F.col("last")))
        .select("user1", F.col("far").alias("friend_of_friend"), reached.alias("lifetime"))
    )


def _unreached(payments: DataFrame) -> DataFrame:
    """E11's rows with a null ``friend_of_friend``."""
    g = graph_of(payments)
    left = g.pair_months.withColumnRenamed("user2", "via")
    return (
        left.join(_runner_up(g.pairs, g.starts), "via", "left")
        .where(F.col("d2").isNull() | (F.col("lo") < F.col("d2")))
        .groupBy("user1")
        .agg(F.min("lifetime").alias("lifetime"))
        .select("user1", F.lit(None).cast("bigint").alias("friend_of_friend"), "lifetime")
    )


def fof_new(
    payments: DataFrame, exclude: str = "same_month", keep_null: bool = True, cut: Cut | None = None, slices: int = 1
) -> DataFrame:
    """Drop friends-of-friends who are direct friends.

    ``same_month`` (as written in the source analysis) drops a
    friend-of-friend only when the direct friendship began in the very same
    month; ``known_by_then`` drops any friend met in that month or earlier.
    Null rows are kept (when ``keep_null``).  ``cut``: only one of ``slices`` of the
    users (``same_month`` without null rows).
    """
    if cut and (keep_null or exclude != "same_month"):
        raise ValueError("a slice has no null rows and excludes by same_month")
    met = graph_of(payments).met.select(
        "user1", F.col("user2").alias("friend_of_friend"), F.col("lifetime").alias("met")
    )
    if exclude == "same_month":
        # the friendships take part in the minimum over (user, friend-of-friend), so nothing is sorted for a join
        none = F.lit(None).cast("bigint")
        met = cut(met) if cut else met
        both = _reached(payments, keep_null, cut=cut, slices=slices).withColumn("met", none).unionByName(
            met.where(F.col("met") <= MAX_LIFETIME).withColumn("lifetime", none)
        )
        fof = (
            both.groupBy("user1", "friend_of_friend")
            .agg(F.min("lifetime").alias("lifetime"), F.min("met").alias("met"))
            .where(F.col("lifetime").isNotNull() & (F.col("met").isNull() | (F.col("met") != F.col("lifetime"))))
            .drop("met")
        )
        return fof.unionByName(_unreached(payments)) if keep_null else fof
    if exclude == "known_by_then":
        fof = fof_first_met(payments, keep_null=keep_null)
        cond = (
            (fof.user1 == met.user1)
            & (fof.friend_of_friend == met.friend_of_friend)
            & (met.met <= fof.lifetime)
        )
        return fof.join(met, cond, "left_anti")
    raise ValueError(f"unknown exclude mode {exclude!r}")


def new_fof(payments: DataFrame) -> DataFrame:
    """New friends-of-friends per month on the 0..12 spine."""
    fof = fof_new(payments, keep_null=False)
    return _count_on_spine(graph_of(payments).spine, fof, "num_fnd_of_fnd")


def cum_fof(payments: DataFrame, lists: bool = False) -> DataFrame:
    """Running total of new friends-of-friends (``lists`` as in ``cum_friends``)."""
    if lists:
        slices = graph_of(payments).slices
        new = in_slices(
            slices, lambda cut: _per_month(fof_new(payments, keep_null=False, cut=cut, slices=slices), "num_fnd_of_fnd"), "fof-months"
        )
        return _running_list(graph_of(payments).starts, new, "num_fnd_of_fnd", "cum_num_fnd_of_fnd")
    return _running_sum(new_fof(payments), "num_fnd_of_fnd", "cum_num_fnd_of_fnd")


def possible_edges(payments: DataFrame) -> DataFrame:
    """Possible edges among the friends known so far, c(c-1)/2."""
    c = F.col("cum_num_friends")
    return cum_friends(payments).select(
        "user1", "lifetime", (c * (c - 1) / F.lit(2)).cast("double").alias("num_vertices")
    )


# --------------------------------------------------------------------------
# Triangles
# --------------------------------------------------------------------------
def triangles(payments: DataFrame) -> DataFrame:
    """Every triangle once, ``a < b < c``, with the time it closed.

    Edges are oriented from the endpoint with lower (degree, id) to the
    higher one; wedges are pairs of out-edges of one node; a wedge closes if
    its two far ends are joined by an oriented edge.
    """
    ids = ["a", "b", "c"]
    return _closed(payments).select(
        F.least(*ids).alias("user_a"),
        F.sort_array(F.array(*ids))[1].alias("user_b"),
        F.greatest(*ids).alias("user_c"),
        "closed_at",
    )


def _closed(payments: DataFrame, months: int | None = None) -> DataFrame:
    """Triangles with their corners in (degree, id) order and each corner's first day, which the edges bring along.

    With ``months``, triangles that close after that month of all three corners
    may be left out: a wedge opened later than that is dropped before it is shuffled.
    """
    g = graph_of(payments)
    d1 = g.nodes.select(F.col("user1").alias("x"), F.col("num_friends").alias("dx"), F.col("start_date").alias("sx"))
    d2 = g.nodes.select(F.col("user1").alias("y"), F.col("num_friends").alias("dy"), F.col("start_date").alias("sy"))
    e = (
        g.undirected.select(F.col("a").alias("x"), F.col("b").alias("y"), "datetime")
        .join(d1, "x")
        .join(d2, "y")
    )
    x_first = (F.col("dx") < F.col("dy")) | ((F.col("dx") == F.col("dy")) & (F.col("x") < F.col("y")))

    def end(first: str, second: str, name: str) -> F.Column:
        return F.when(x_first, F.col(first)).otherwise(F.col(second)).alias(name)

    oriented = e.select(
        end("x", "y", "src"), end("y", "x", "dst"), end("dy", "dx", "ddst"), end("sx", "sy", "s_src"), end("sy", "sx", "s_dst"),
        "datetime",
    )
    o1 = oriented.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("ddst").alias("db"),
                         F.col("s_src").alias("start_a"), F.col("s_dst").alias("_sb"), F.col("datetime").alias("t_ab"))
    o2 = oriented.select(F.col("src").alias("a"), F.col("dst").alias("c"), F.col("ddst").alias("dc"),
                         F.col("s_dst").alias("_sc"), F.col("datetime").alias("t_ac"))
    b_first = (F.col("db") < F.col("dc")) | ((F.col("db") == F.col("dc")) & (F.col("b") < F.col("c")))
    opened = F.greatest("t_ab", "t_ac")
    early = F.lit(True) if months is None else lifetime_month(opened, F.greatest("start_a", "_sb", "_sc")) <= months
    wedges = o1.join(o2, "a").where(b_first & early).select("a", "b", "c", "start_a", opened.alias("t_a"))
    closing = oriented.select(F.col("src").alias("b"), F.col("dst").alias("c"), F.col("s_src").alias("start_b"),
                              F.col("s_dst").alias("start_c"), F.col("datetime").alias("t_bc"))
    # wedges outnumber edges by far: they stream past a hash of the edges, one per key, and are not sorted
    tri = wedges.join(closing.hint("shuffle_hash"), ["b", "c"])
    return tri.select("a", "b", "c", "start_a", "start_b", "start_c", F.greatest("t_a", "t_bc").alias("closed_at"))


def triangle_month(payments: DataFrame, friends: bool = True, months: int | None = None) -> DataFrame:
    """Each triangle at each of its three corners, in the corner's month (``friends``: with the other two).

    ``months``: the last month wanted; corners in later ones may be left out.
    """

    def corner(own: str, *others: str) -> F.Column:
        month = lifetime_month("closed_at", f"start_{own}").alias("lifetime")
        ends = [F.least(*others).alias("friend_a"), F.greatest(*others).alias("friend_b")] if friends else []
        return F.struct(F.col(own).alias("user1"), *ends, month)

    corners = F.array(corner("a", "b", "c"), corner("b", "a", "c"), corner("c", "a", "b"))
    return _closed(payments, months).select(F.explode(corners).alias("k")).select("k.*")


def new_triangles(payments: DataFrame) -> DataFrame:
    """Triangles closed per user and month (months 0..12 only)."""
    return (
        triangle_month(payments, friends=False, months=MAX_LIFETIME)
        .where(F.col("lifetime") <= MAX_LIFETIME)
        .groupBy("user1", "lifetime")
        .agg(F.count(F.lit(1)).cast("double").alias("num_triangles"))
    )


def triangles_panel(payments: DataFrame) -> DataFrame:
    """Triangles per month, zero-filled on the 0..12 spine."""
    return graph_of(payments).spine.join(new_triangles(payments), ["user1", "lifetime"], "left").select(
        "user1", "lifetime", F.coalesce(F.col("num_triangles"), F.lit(0.0)).alias("num_triangles")
    )


def cum_triangles(payments: DataFrame, lists: bool = False) -> DataFrame:
    """Running total of triangles (``lists`` as in ``cum_friends``)."""
    if lists:
        return _running_list(graph_of(payments).starts, new_triangles(payments), "num_triangles", "cum_num_triangles")
    return _running_sum(triangles_panel(payments), "num_triangles", "cum_num_triangles")


def clustering_coefficient(payments: DataFrame) -> DataFrame:
    """Cumulative triangles / possible edges; null below two friends."""
    tri = cum_triangles(payments)
    pos = possible_edges(payments)
    return tri.join(pos, ["user1", "lifetime"]).select(
        "user1",
        "lifetime",
        (F.col("cum_num_triangles") / F.nullif(F.col("num_vertices"), F.lit(0.0))).alias(
            "cluster_coefficient"
        ),
    )
