"""Per-month linear models F14-F20.

The source analysis fits one model per lifetime month and feature set (13 × 4
separate MLlib jobs, each re-running the whole lineage).  Here every month
is fitted, tested and described in one pass over its panel:

1. ``groupBy(lifetime, split)`` sums of x, y, xxᵀ and xy — a single aggregation
   with map-side partial sums; two tiny rows a month come out.
2. ``applyInPandas`` sweeps each month's k×k correlation matrix (k ≤ 15).  That
   gives the coefficients, the inverse for standard errors and p-values, and the
   rank; the error on the test rows follows from their own sums.  This is the
   only Python, on 26 rows.

A column that is constant, or depends linearly on the columns before it, is
dropped: its coefficient is 0, its standard error and p-value are null, and its
name is in ``dropped``.

The train/test split hashes ``user1`` so that it is deterministic for any
partitioning and a user's rows never straddle train and test.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.schema import PROFILE_COLUMNS
from ledgerlens.session import materialize

# Split and feature lists.
TRAIN_BUCKETS = 7  # of 10 hash buckets → 70 / 30
LABEL = "num_transaction"
NETWORK_FEATURES = ["num_friends", "num_friends_of_friends", "num_triangles", "page_rank"]
MODEL_FEATURES = {
    1: ["frequency", "recency"],
    2: ["lifetime", "frequency", "recency", *PROFILE_COLUMNS],
    3: ["lifetime", *NETWORK_FEATURES],
    4: [*PROFILE_COLUMNS, *NETWORK_FEATURES],
}
# Variance below this share of the mean square counts as a constant column,
# whatever the column's unit.
CONSTANT_TOL = 1e-10
# A column of which earlier columns explain all but this share is dropped (the usual tolerance of statistics packages).
COLLINEAR_TOL = 1e-7


def split_column(user_col: str = "user1") -> F.Column:
    """Bucket 0..9 from the leading hexadecimal digits of the id's MD5, which any engine can compute."""
    digest = F.md5(F.col(user_col).cast("string").cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10
    return F.when(bucket < TRAIN_BUCKETS, F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, user_col: str = "user1") -> DataFrame:
    """add ``split`` ∈ {train, test} from a hash of the user id."""
    return df.withColumn("split", split_column(user_col))


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """MLlib feature vector."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=features, outputCol=output).transform(df)


def _moment_aggs(features: list[str], label: str) -> list:
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(xi).alias(f"sx_{i}") for i, xi in enumerate(x)]
    aggs += [F.sum(xi * y).alias(f"sxy_{i}") for i, xi in enumerate(x)]
    aggs += [
        F.sum(x[i] * x[j]).alias(f"sxx_{i}_{j}") for i in range(len(x)) for j in range(i, len(x))
    ]
    return aggs


def t_two_sided(t: float, df: float) -> float:
    """Chance of a Student t at least as far from 0: the incomplete beta function by its continued fraction."""
    if not math.isfinite(t):
        return 0.0
    if df > 1e6:  # normal to within 1 / df
        return math.erfc(abs(t) / math.sqrt(2.0))
    x, a, b = df / (df + t * t), df / 2.0, 0.5
    flip = x > (a + 1.0) / (a + b + 2.0)
    if flip:
        x, a, b = 1.0 - x, b, a
    if x <= 0.0:
        return 1.0 if flip else 0.0
    value, c, d = 1.0, 1.0, 0.0
    for i in range(1000):
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (1.0 + num * d if 1.0 + num * d else 1e-300)
        c = 1.0 + num / c if 1.0 + num / c else 1e-300
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    part = front * (value - 1.0)
    return 1.0 - part if flip else part


def sweep(corr: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Inverse of a correlation matrix on the columns that are kept, in order, and those columns."""
    a, kept = corr.copy(), []
    for p in range(len(a)):
        pivot = a[p, p]
        if not usable[p] or pivot <= COLLINEAR_TOL:
            continue
        kept.append(p)
        row, column = a[p] / pivot, a[:, p].copy()
        a -= np.outer(column, row)
        a[p], a[:, p] = row, -column / pivot
        a[p, p] = 1.0 / pivot
    return a[np.ix_(kept, kept)], kept


class _Moments:
    """Sums of one group's rows."""

    def __init__(self, row: pd.Series, k: int):
        self.n, self.sy, self.syy = int(row["n"]), float(row["sy"]), float(row["syy"])
        self.sx = np.array([row[f"sx_{i}"] for i in range(k)], dtype=float)
        self.sxy = np.array([row[f"sxy_{i}"] for i in range(k)], dtype=float)
        self.sxx = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                self.sxx[i, j] = self.sxx[j, i] = row[f"sxx_{i}_{j}"]

    def around(self, x: np.ndarray, y: float) -> tuple[np.ndarray, np.ndarray, float]:
        """Means of products of deviations from a point: xx, xy and yy."""
        n, dx, dy = self.n, self.sx / self.n - x, self.sy / self.n - y
        mx, my = self.sx / n, self.sy / n
        xx = self.sxx / n - np.outer(mx, mx) + np.outer(dx, dx)
        return xx, self.sxy / n - mx * my + dx * dy, self.syy / n - my * my + dy * dy


def _solver(features: list[str], group: str):
    k = len(features)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = {r["split"]: _Moments(r, k) for _, r in pdf.iterrows()}
        test = rows.get("test")
        out = {group: [pdf[group].iloc[0]], "n_test": [test.n if test else 0]}
        if "train" not in rows:
            return pd.DataFrame({**out, "n_train": [0], "rank": [0], "dropped": [",".join(features)]})
        train = rows["train"]
        n, mean, ybar = train.n, train.sx / train.n, train.sy / train.n
        cov, cxy, vy = train.around(mean, ybar)
        usable = np.diag(cov) > CONSTANT_TOL * np.diag(train.sxx) / n
        # Swept as a correlation matrix, so a column of small numbers
        # (PageRank averages 1/N) weighs as much as any other.
        scale = np.where(usable, np.sqrt(np.maximum(np.diag(cov), 0.0)), 1.0)
        inverse, kept = sweep(np.where(np.outer(usable, usable), cov / np.outer(scale, scale), 0.0), usable)
        inverse = inverse / np.outer(scale[kept], scale[kept])
        beta = np.zeros(k)
        beta[kept] = inverse @ cxy[kept]
        out |= {
            "n_train": [n],
            "rank": [len(kept)],
            "dropped": [",".join(f for i, f in enumerate(features) if i not in kept)],
            "intercept": [ybar - float(beta @ mean)],
            **{f"b_{i}": [float(beta[i])] for i in range(k)},
        }
        free = n - len(kept) - 1
        if free > 0:
            left = max(vy - float(beta @ cxy), 0.0) * n / free
            error = {i: math.sqrt(left * v / n) for i, v in zip(kept, np.diag(inverse))}
            at_mean = float(mean[kept] @ inverse @ mean[kept])
            error["intercept"] = math.sqrt(left * (1.0 + at_mean) / n)
            value = {**{i: float(beta[i]) for i in kept}, "intercept": out["intercept"][0]}
            for i, e in error.items():
                out[f"se_{i}"] = [e]
                out[f"p_{i}"] = [t_two_sided(value[i] / e, free) if e else (0.0 if value[i] else 1.0)]
        if test:
            xx, xy, yy = test.around(mean, ybar)
            out["mse"] = [max(float(yy - 2.0 * beta @ xy + beta @ xx @ beta), 0.0)]
        return pd.DataFrame(out)

    names = [group, "n_train", "n_test", "rank", "dropped", "intercept"]
    slots = [*range(k), "intercept"]
    names += [f"b_{i}" for i in range(k)] + [f"se_{i}" for i in slots] + [f"p_{i}" for i in slots] + ["mse"]
    return lambda pdf: solve(pdf).reindex(columns=names)


def fit_by_group(
    df: DataFrame, features: list[str], label: str = LABEL, group: str = "lifetime"
) -> DataFrame:
    """Least-squares fit per group from one aggregation pass.

    One row per group: ``n_train, n_test, rank, dropped, intercept``, the
    coefficients ``b_i``, standard errors ``se_i`` and p-values ``p_i`` (``i`` the
    feature's number, or ``intercept``), and the test rows' ``mse``.  Rows with
    ``split`` = test are not fitted; without a ``split`` column all rows are.
    A group without test rows has a null ``mse``.
    """
    k = len(features)
    rows = df if "split" in df.columns else df.withColumn("split", F.lit("train"))
    stats = rows.groupBy(group, "split").agg(*_moment_aggs(features, label))
    slots = [*range(k), "intercept"]
    reals = [f"b_{i}" for i in range(k)] + [f"se_{i}" for i in slots] + [f"p_{i}" for i in slots] + ["mse"]
    schema = f"{group} bigint, n_train bigint, n_test bigint, rank int, dropped string, intercept double, "
    return stats.groupBy(group).applyInPandas(_solver(features, group), schema + ", ".join(f"{c} double" for c in reals))


def ols_by_month(
    df: DataFrame, features: list[str], label: str = LABEL, group: str = "lifetime", model: int = 0
) -> DataFrame:
    """F16: per month — train size, test size, rank, dropped columns and test-set MSE."""
    split = df if "split" in df.columns else train_test_split(df)
    fit = fit_by_group(split, features, label, group)
    return fit.select(F.lit(model).alias("model"), group, "n_train", "n_test", "rank", "dropped", "mse")


def mse_series(inputs: dict[int, DataFrame]) -> DataFrame:
    """MSE by month for each model (model → its input panel).

    Each model's rows are stored before the next is fitted, so the disk holds the shuffles of one panel at a time.
    """
    out = None
    for model, df in sorted(inputs.items()):
        part = materialize(ols_by_month(df, MODEL_FEATURES[model], model=model), f"fit-{model}")
        out = part if out is None else out.unionByName(part)
    return out


def standardize(df: DataFrame, col: str, out_col: str | None = None, by: str | None = None) -> DataFrame:
    """z-score of ``col`` (sample standard deviation).

    Without ``by`` the mean and deviation come from one aggregate pass (two
    numbers reach the driver) and are applied as literals; with ``by`` they
    come from a grouped aggregate joined on the group key.  Either way no
    single-partition window.
    """
    out_col = out_col or f"std_{col}"
    if by is None:
        mean, std = df.agg(F.avg(col), F.stddev_samp(col)).first()
        return df.withColumn(out_col, F.try_divide(F.col(col) - F.lit(mean), F.lit(std)))
    stats = df.groupBy(by).agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    if by == "lifetime":  # 13 rows: a shuffle join would put a whole month into one task
        stats = F.broadcast(stats)
    return (
        df.join(stats, by)
        .withColumn(out_col, F.try_divide(F.col(col) - F.col("_mu"), F.col("_sd")))
        .drop("_mu", "_sd")
    )


def coefficient_table(df: DataFrame, features: list[str], label: str = LABEL, group: str = "lifetime") -> DataFrame:
    """coefficients, standard errors and p-values of every month, from the fit's own sums.

    One row per month and feature, and one for the ``intercept``.  A dropped column has
    coefficient 0 and null error and p-value; so have all where no degree of freedom is left.
    """
    fit = fit_by_group(train_test_split(df).where(F.col("split") == "train"), features, label, group)
    names = [*[(str(i), f, F.col(f"b_{i}")) for i, f in enumerate(features)], ("intercept", "intercept", F.col("intercept"))]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                value.alias("coefficient"),
                F.col(f"se_{i}").alias("std_error"),
                F.col(f"p_{i}").alias("p_value"),
            )
            for i, name, value in names
        ]
    )
    return fit.select(group, F.explode(rows).alias("r")).select(group, "r.*")


def model_comparison(series: DataFrame) -> DataFrame:
    """MSE of each model side by side per month, best model, and flags.

    ``leak`` marks month 12, where frequency equals Y/360 so models 1 and 2
    fit exactly and must be left out of the comparison.
    """
    wide = series.groupBy("lifetime").pivot("model", [1, 2, 3, 4]).agg(F.first("mse"))
    wide = wide.select("lifetime", *[F.col(str(m)).alias(f"mse_model{m}") for m in (1, 2, 3, 4)])
    cols = [f"mse_model{m}" for m in (1, 2, 3, 4)]
    least = F.least(*[F.col(c) for c in cols])
    best = F.lit(None).cast("int")
    for m in (4, 3, 2, 1):
        best = F.when(F.col(f"mse_model{m}") == least, F.lit(m)).otherwise(best)
    return wide.select(
        "lifetime",
        *cols,
        best.alias("best_model"),
        *[(F.col(f"mse_model{m}") - F.col("mse_model1")).alias(f"delta_model{m}") for m in (2, 3, 4)],
        (F.col("lifetime") == 12).alias("leak"),
    )
