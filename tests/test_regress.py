"""Grouped OLS against MLlib, split determinism, coefficient table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features, rank, regress
from ledgerlens.sources import derive_payments, fixture_dictionary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def payments(spark):
    return derive_payments(spark, SF).cache()


def _mllib_mse(df, feats):
    from pyspark.ml.regression import LinearRegression

    split = regress.train_test_split(df)
    train = regress.assemble(split.where("split = 'train'"), feats)
    test = regress.assemble(split.where("split = 'test'"), feats)
    model = LinearRegression(featuresCol="features", labelCol="num_transaction", solver="normal").fit(train)
    return model.evaluate(test).rootMeanSquaredError ** 2


@pytest.mark.parametrize("month", [1, 6, 11])
def test_model1_matches_mllib(payments, month):
    df = features.model1_input(payments)
    ours = {r.lifetime: r.mse for r in regress.ols_by_month(df, regress.MODEL_FEATURES[1]).collect()}
    want = _mllib_mse(df.where(F.col("lifetime") == month), regress.MODEL_FEATURES[1])
    assert ours[month] == pytest.approx(want, rel=1e-6)


def test_model3_matches_mllib(payments):
    df = features.model3_input(payments, rank.page_rank(payments))
    feats = regress.MODEL_FEATURES[3][1:]  # lifetime is constant within a month
    ours = {r.lifetime: r.mse for r in regress.ols_by_month(df, regress.MODEL_FEATURES[3]).collect()}
    want = _mllib_mse(df.where(F.col("lifetime") == 6), feats)
    assert ours[6] == pytest.approx(want, rel=1e-6)


def test_split_is_partition_independent(payments):
    df = features.model1_input(payments)
    a = {(r.user1, r.lifetime): r.split for r in regress.train_test_split(df.repartition(1)).collect()}
    b = {(r.user1, r.lifetime): r.split for r in regress.train_test_split(df.repartition(7)).collect()}
    assert a == b
    users = {}
    for (u, _), s in a.items():
        users.setdefault(u, set()).add(s)
    assert all(len(s) == 1 for s in users.values())


def test_month_zero_is_constant_model(payments):
    df = features.model1_input(payments)
    mse0 = [r for r in regress.ols_by_month(df, regress.MODEL_FEATURES[1]).collect() if r.lifetime == 0][0]
    test = regress.train_test_split(df).where("lifetime = 0")
    ybar_train = test.where("split = 'train'").agg(F.avg("num_transaction")).first()[0]
    want = test.where("split = 'test'").agg(F.avg((F.col("num_transaction") - ybar_train) ** 2)).first()[0]
    assert mse0.mse == pytest.approx(want, rel=1e-9)


def test_series_comparison_and_coefficients(spark, payments):
    dic = fixture_dictionary(spark)
    ranks = rank.page_rank(payments)
    inputs = {
        1: features.model1_input(payments),
        2: features.model2_input(payments, dic),
        3: features.model3_input(payments, ranks),
        4: features.model4_input(payments, dic, ranks),
    }
    series = regress.mse_series(inputs).cache()
    assert series.count() == 4 * 13
    comp = regress.model_comparison(series).collect()
    assert len(comp) == 13 and [r for r in comp if r.lifetime == 12][0].leak
    m12 = inputs[3].where("lifetime = 12")
    z = regress.standardize(m12, "page_rank")
    mean, sd = z.agg(F.avg("std_page_rank"), F.stddev_samp("std_page_rank")).first()
    assert abs(mean) < 1e-9 and abs(sd - 1) < 1e-9
    table = regress.coefficient_table(z, ["num_friends", "num_friends_of_friends", "num_triangles", "std_page_rank"])
    assert [r.feature for r in table.collect()][-1] == "intercept"


def test_fit_does_not_depend_on_a_columns_unit(spark):
    """PageRank-like columns average 1/N; at a million users their variance is about 1e-13."""
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=(4000, 2))
    y = 3.0 * x[:, 0] + 5.0 * x[:, 1] + rng.normal(size=4000)
    for unit in (1.0, 1e-6, 1e-9):
        rows = [(0, float(a), float(b * unit), 7.0 * unit, float(c)) for (a, b), c in zip(x, y)]
        df = spark.createDataFrame(rows, "lifetime long, a double, b double, c double, num_transaction double")
        fit = regress.fit_by_group(df, ["a", "b", "c"]).first()
        assert fit["rank"] == 2 and fit["b_2"] == 0.0
        assert abs(fit["b_0"] - 3.0) < 0.1 and abs(fit["b_1"] * unit - 5.0) < 0.1


def test_standardize_constant_column_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "user1 long, v double")
    assert {r.std_v for r in regress.standardize(df, "v").collect()} == {None}


def test_pagerank_reports_no_convergence_and_takes_no_edges(spark):
    path = [(i, i + 1) for i in range(60)]
    edges = spark.createDataFrame(path + [(b, a) for a, b in path], "src long, dst long")
    with pytest.raises(RuntimeError, match="did not reach"):
        rank.pagerank(edges, max_iter=2, tol=1e-12)
    assert rank.pagerank(edges.limit(0)).count() == 0
