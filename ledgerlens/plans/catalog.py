"""Named queries: one per operator of the inventory, each (spark, sf_dir) → DataFrame.

Every query reads the generated tables of ``sf_dir`` (through the derived
payment log) and runs over all of it.  Floating outputs that come out of
long sums (PageRank, z-scores, MSE) are rounded at the edge of the query so
that engines summing in a different order still agree; operators themselves
never round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import clock, features, graph, profile, rank, regress, text
from ledgerlens.schema import MAX_LIFETIME, NOT_CLASSIFIED, PROFILE_COLUMNS
from ledgerlens.session import materialize, scratch_dir
from ledgerlens.sources import derive_payments, fixture_dictionary, read_panel, stored_payments, write_panel

Query = Callable[[SparkSession, str], DataFrame]

RANK_DIGITS = 12
MSE_DIGITS = 6
COEF_DIGITS = 6
Z_DIGITS = 9
SHARE_DIGITS = 7


def _p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_payments(spark, sf_dir)


def _pd(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stored_payments(spark, sf_dir), fixture_dictionary(spark)


def _round(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ----------------------------------------------------------------- A, C -----
def q_read_payments(spark, d):
    return derive_payments(spark, d)


def q_normalize_text(spark, d):
    return text.normalize_text(_p(spark, d))


def q_contains_emoji(spark, d):
    return text.contains_emoji_flag(_p(spark, d))


def q_token_category(spark, d):
    p, dic = _pd(spark, d)
    toks = text.description_tokens(p).select("token").distinct()
    cats = text.token_category(dic)
    return toks.join(cats, "token", "left").select("token", text.category_name("tok_rk").alias("category"))


def q_classify(spark, d):
    p, dic = _pd(spark, d)
    descs = p.select("description").where(F.col("description").isNotNull()).distinct()
    return descs.join(text.classify(p, dic), "description", "left").select(
        "description", F.coalesce(F.col("category"), F.lit(NOT_CLASSIFIED)).alias("category")
    )


def q_payments_with_category(spark, d):
    return text.payments_with_category(*_pd(spark, d))


def q_emoji_only_flag(spark, d):
    return text.emoji_only_flag(_p(spark, d))


def q_emoji_only_count(spark, d):
    return text.emoji_only_count(_p(spark, d))


def q_emoji_only_share(spark, d):
    return text.emoji_only_share(_p(spark, d))


def q_extract_emojis(spark, d):
    return text.with_emojis(_p(spark, d))


def q_blank_to_null(spark, d):
    return text.blank_to_null(_p(spark, d))


def q_has_emoji_payments(spark, d):
    return text.has_emoji_payments(_p(spark, d))


def q_emoji_explode(spark, d):
    return text.emoji_explode(_p(spark, d))


def q_emoji_frequency(spark, d):
    return text.emoji_frequency(_p(spark, d))


def q_top5_emojis(spark, d):
    return text.top_emojis(_p(spark, d), 5)


def q_emoji_category_counts(spark, d):
    return text.emoji_category_counts(*_pd(spark, d))


def q_top_emoji_categories(spark, d):
    return text.top_emoji_categories(*_pd(spark, d), 3)


# -------------------------------------------------------------------- D -----
def q_category_share(spark, d):
    return profile.category_share(*_pd(spark, d))


def q_spending_profile(spark, d):
    return profile.spending_profile(*_pd(spark, d))


def q_first_activity(spark, d):
    return clock.first_activity(_p(spark, d))


def q_lifetime_month(spark, d):
    return profile.category_rows(*_pd(spark, d))


def q_monthly_category_share(spark, d):
    return profile.monthly_category_share(*_pd(spark, d))


def q_distinct_categories(spark, d):
    return profile.distinct_categories(*_pd(spark, d))


def q_dynamic_profile(spark, d):
    return profile.dynamic_profile(*_pd(spark, d))


def q_running_profile(spark, d):
    return profile.running_profile(*_pd(spark, d))


def q_cumulative_profile(spark, d):
    return profile.cumulative_profile(*_pd(spark, d))


# -------------------------------------------------------------------- E -----
def q_friend_pairs(spark, d):
    return graph.friend_pairs(_p(spark, d))


def q_friend_list(spark, d):
    return graph.friend_list(_p(spark, d))


def q_two_hop(spark, d):
    return graph.two_hop(_p(spark, d))


def q_two_hop_only(spark, d):
    return graph.two_hop_only(_p(spark, d))


def q_symmetric_log(spark, d):
    return clock.symmetric_log(_p(spark, d))


def q_both_clock(spark, d):
    return graph.both_clock_rows(_p(spark, d))


def q_first_met(spark, d):
    return graph.first_met(_p(spark, d))


def q_lifetime_spine(spark, d):
    return graph.graph_spine(_p(spark, d))


def q_new_friends(spark, d):
    return graph.new_friends(_p(spark, d))


def q_cum_friends(spark, d):
    return graph.cum_friends(_p(spark, d))


def q_fof_first_met(spark, d):
    return graph.fof_first_met(_p(spark, d))


def q_fof_new(spark, d):
    return graph.fof_new(_p(spark, d))


def q_new_fof(spark, d):
    return graph.new_fof(_p(spark, d))


def q_cum_fof(spark, d):
    return graph.cum_fof(_p(spark, d))


def q_possible_edges(spark, d):
    return graph.possible_edges(_p(spark, d))


def q_first_edges(spark, d):
    return graph.first_edges(_p(spark, d))


def q_triangles(spark, d):
    return graph.triangles(_p(spark, d))


def q_triangle_month(spark, d):
    return graph.triangle_month(_p(spark, d))


def q_new_triangles(spark, d):
    return graph.new_triangles(_p(spark, d))


def q_triangles_panel(spark, d):
    return graph.triangles_panel(_p(spark, d))


def q_cum_triangles(spark, d):
    return graph.cum_triangles(_p(spark, d))


def q_clustering_coefficient(spark, d):
    return graph.clustering_coefficient(_p(spark, d))


def q_pagerank(spark, d):
    return _round(rank.page_rank(_p(spark, d), settled=True), ["PageRank"], RANK_DIGITS)


def q_pagerank_by_month(spark, d):
    ranks = rank.page_rank_by_month(_p(spark, d), settled=True)
    return _round(ranks, ["page_rank"], RANK_DIGITS)


# -------------------------------------------------------------------- F -----
def q_first_year_txn(spark, d):
    return features.first_year_txn(_p(spark, d))


def q_sender_clock(spark, d):
    return clock.sender_clock(_p(spark, d))


def q_rf_monthly(spark, d):
    return features.rf_monthly(_p(spark, d))


def q_rf_panel(spark, d):
    return features.rf_panel(_p(spark, d))


def q_frequency(spark, d):
    return features.rf_model(_p(spark, d)).select("user1", "lifetime", "lifetime_days", "frequency")


def q_recency(spark, d):
    return features.rf_model(_p(spark, d)).select("user1", "lifetime", "lifetime_days", "recency")


def q_model1_input(spark, d):
    return features.model1_input(_p(spark, d))


def q_model2_input(spark, d):
    return features.model2_input(*_pd(spark, d))


def q_model3_input(spark, d):
    p = _p(spark, d)
    return _round(features.model3_input(p, rank.page_rank(p)), ["page_rank"], RANK_DIGITS)


def q_dual_clock(spark, d):
    p = _p(spark, d)
    return clock.dual_clock(p, graph.graph_of(p).starts)


def q_friend_profile(spark, d):
    return features.friend_profile(*_pd(spark, d))


def q_model4_input(spark, d):
    p, dic = _pd(spark, d)
    return _round(features.model4_input(p, dic, rank.page_rank(p)), ["page_rank"], RANK_DIGITS)


def q_network_profile(spark, d):
    # Averages of hundredths often end in an exact half; the nudge lets both engines round it up.
    out = features.network_profile(*_pd(spark, d))
    nudged = out.select("user1", "lifetime", "hop", "n_contacts", *[(F.col(c) + 1e-11).alias(c) for c in PROFILE_COLUMNS])
    return _round(nudged, PROFILE_COLUMNS, SHARE_DIGITS)


def q_train_test_split(spark, d):
    return regress.train_test_split(features.model1_input(_p(spark, d)))


def q_ols_by_month(spark, d):
    out = regress.ols_by_month(features.model1_input(_p(spark, d)), regress.MODEL_FEATURES[1], model=1)
    return _round(out, ["mse"], MSE_DIGITS)


def _model3(p: DataFrame) -> DataFrame:
    """The model-3 panel, written once for use by several passes."""
    return materialize(features.model3_input(p), "model3")


def _model_inputs(spark, d) -> dict[int, DataFrame]:
    p, dic = _pd(spark, d)
    features.keep_monthly(p, dic)
    network = _model3(p)
    return {
        1: features.model1_input(p),
        2: features.model2_input(p, dic),
        3: network,
        4: features.friend_profile(p, dic).join(network, ["user1", "lifetime"]),
    }


def q_assemble(spark, d):
    """Feature vectors of model 2, taken apart again: a row per user, month and place in the vector."""
    names = regress.MODEL_FEATURES[2]
    vectors = regress.assemble(features.model2_input(*_pd(spark, d)), names)
    parts = vectors.select("user1", F.col("lifetime").alias("month"), F.posexplode(vector_to_array("features")).alias("pos", "value"))
    return parts.select("user1", "month", "pos", F.element_at(F.array(*map(F.lit, names)), F.col("pos") + 1).alias("feature"), "value")


def q_mse_series(spark, d):
    return _round(regress.mse_series(_model_inputs(spark, d)), ["mse"], MSE_DIGITS)


def q_standardize(spark, d):
    m12 = _model3(_p(spark, d)).where(F.col("lifetime") == MAX_LIFETIME)
    z = regress.standardize(m12, "page_rank").drop("page_rank")
    return _round(z, ["std_page_rank"], Z_DIGITS)


def q_coefficient_table(spark, d):
    z = regress.standardize(_model3(_p(spark, d)), "page_rank", by="lifetime")
    table = regress.coefficient_table(z, [*regress.NETWORK_FEATURES[:3], "std_page_rank"])
    return _round(table, ["coefficient", "std_error", "p_value"], COEF_DIGITS)


def q_model_comparison(spark, d):
    # months that a model fits exactly have errors of rounding size, which must not decide which is best
    series = _round(regress.mse_series(_model_inputs(spark, d)), ["mse"], MSE_DIGITS)
    wide = regress.model_comparison(series)
    return _round(wide, [c for c in wide.columns if c.startswith("delta_")], MSE_DIGITS)


# ------------------------------------------------------------- A3 / A4 -----
def _panel_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def q_write_panel(spark, d):
    """The recency/frequency panel stored by month, its last month then written again; nothing is doubled."""
    path = _panel_path(spark, "panel")
    panel = features.rf_model(_p(spark, d))
    write_panel(panel, path)
    write_panel(panel.where(F.col("lifetime") == MAX_LIFETIME), path)
    return _month_as_long(read_panel(spark, path))


def q_read_panel(spark, d):
    """Stored recency/frequency rows of the months after the first with most payments, found at run time."""
    path = _panel_path(spark, "panel")
    write_panel(features.rf_panel(_p(spark, d)), path)
    totals = read_panel(spark, path).groupBy("lifetime").agg(F.sum("num_txn").alias("paid"))
    totals = materialize(totals.where("lifetime > 0"), "panel-months")
    most = totals.agg(F.max("paid")).first()[0]
    return _month_as_long(read_panel(spark, path, months=totals.where(F.col("paid") >= F.lit(most))))


def _month_as_long(panel: DataFrame) -> DataFrame:
    """A partition column comes back as int."""
    return panel.withColumn("lifetime", F.col("lifetime").cast("bigint"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
