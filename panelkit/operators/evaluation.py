"""Time-respecting evaluation of linear models from one pass over the rows.

A ridge regression needs its training rows only through sums: counts, sums
and products of the features and the label. They are taken once per month and
cumulated over months, so every expanding fold is fitted in closed form
without reading its rows again; the rows are read a second time to score
them. Missing features take the mean of the fold's own training rows, which
the same sums give (a missing flag per nullable feature takes part in them).
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.numeric import null_nan, rnd

_MODEL = "intercept double, means array<double>, scales array<double>, weights array<double>"


@dataclass(frozen=True)
class Design:
    """Features (numeric columns), the nullable ones among them, the label and the time column."""

    features: list[str]
    label: str
    time_col: str
    nullable: tuple[str, ...] = ()

    def terms(self) -> list:
        """1, the features with 0 for a missing value, the missing flags, the label."""
        values = []
        for c in self.features:
            missing = F.lit(0.0) if c in self.nullable else F.raise_error(F.lit(f"NULL in feature {c}")).cast("double")
            values.append(F.coalesce(null_nan(c), missing))
        flags = [null_nan(c).isNull().cast("double") for c in self.nullable]
        return [F.lit(1.0), *values, *flags, F.col(self.label).cast("double")]


def month_moments(df: DataFrame, design: Design) -> DataFrame:
    """One row per month with ``sums``: the upper triangle of the terms' product sums.

    An ordinary aggregate (combined map-side), so the shuffle carries one row
    per task and month. Rows without a label or a month are left out.
    """
    terms = design.terms()
    size = len(terms)
    staged = df.where(F.col(design.label).isNotNull() & F.col(design.time_col).isNotNull()).select(
        design.time_col, *[t.alias(f"z{i}") for i, t in enumerate(terms)])
    sums = [F.sum(F.col(f"z{i}") * F.col(f"z{j}")) for i in range(size) for j in range(i, size)]
    return staged.groupBy(design.time_col).agg(F.array(*sums).alias("sums"))


def expanding_moments(moments: DataFrame, time_col: str, k: int) -> DataFrame:
    """(fold, train_months, first_test, last_test, sums) of ``k`` expanding folds.

    With ``n`` months and ``size = n // (k + 1)``, fold ``f`` trains on months
    1 to ``f * size`` and tests on the next ``size`` (the last fold: on all
    that remain). The table has one row per month, a bound set by the time
    span, so it is cumulated in one window.
    """
    order = Window.orderBy(time_col)
    placed = moments.withColumns({"pos": F.row_number().over(order), "n": F.count(F.lit(1)).over(Window.partitionBy())})
    cells = placed.select(time_col, "pos", "n", F.posexplode("sums").alias("cell", "value"))
    running = Window.partitionBy("cell").orderBy(time_col).rowsBetween(Window.unboundedPreceding, 0)
    total = (cells.withColumn("value", F.sum("value").over(running)).groupBy("pos", "n")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "value"))), lambda e: e["value"]).alias("sums")))
    size = F.floor(F.col("n") / F.lit(k + 1))
    folds = total.where((size > 0) & (F.col("pos") % size == 0)).withColumn("fold", (F.col("pos") / size).cast("int"))
    return folds.where(F.col("fold").between(1, k)).select(
        "fold", F.col("pos").alias("train_months"), (F.col("pos") + 1).alias("first_test"),
        F.when(F.col("fold") == k, F.col("n")).otherwise(F.col("pos") + size).cast("int").alias("last_test"), "sums")


def ridge(sums, design: Design, alpha: float):
    """Column: the ridge model of each row's sums (standardised features, free intercept, penalty ``alpha``)."""
    d, nullable = len(design.features), [design.features.index(c) for c in design.nullable]

    @F.pandas_udf(_MODEL)
    def solve(sums: pd.Series) -> pd.DataFrame:
        import numpy as np

        rows = []
        size = d + len(nullable) + 2
        for flat in sums:
            g = np.zeros((size, size))
            g[np.triu_indices(size)] = flat
            g = g + np.triu(g, 1).T
            n = g[0, 0]
            seen = np.full(d, n)
            for slot, feature in enumerate(nullable):
                seen[feature] -= g[0, 1 + d + slot]
            means = np.divide(g[0, 1:1 + d], seen, out=np.zeros(d), where=seen > 0)
            turn = np.zeros((d + 2, size))   # 1, imputed features, label from the terms
            turn[:d + 1, :d + 1] = np.eye(d + 1)
            turn[d + 1, -1] = 1
            for slot, feature in enumerate(nullable):
                turn[1 + feature, 1 + d + slot] = means[feature]
            m = turn @ g @ turn.T
            spread = m - np.outer(m[0], m[0]) / n
            diag = np.diag(spread)[1:-1]
            scales = np.where(diag > 1e-12 * np.diag(m)[1:-1], np.sqrt(np.maximum(diag, 0) / n), 1.0)
            alive = diag > 1e-12 * np.diag(m)[1:-1]
            a = np.where(np.outer(alive, alive), spread[1:-1, 1:-1] / np.outer(scales, scales), 0) + alpha * np.eye(d)
            b = np.where(alive, spread[1:-1, -1] / scales, 0)
            rows.append((m[0, -1] / n, means.tolist(), scales.tolist(), np.linalg.solve(a, b).tolist()))
        return pd.DataFrame(rows, columns=["intercept", "means", "scales", "weights"])

    return solve(sums)


def expanding_ridge(df: DataFrame, design: Design, k: int, alpha: float = 1.0) -> DataFrame:
    """One fitted ridge model per expanding fold: fold, train_months, first_test, last_test, n_train, model."""
    folds = expanding_moments(month_moments(df, design), design.time_col, k)
    return folds.select("fold", "train_months", "first_test", "last_test",
                        F.col("sums")[0].cast("long").alias("n_train"),
                        ridge(F.col("sums"), design, alpha).alias("model"))


def coefficients(models: DataFrame, design: Design) -> DataFrame:
    """(fold, feature, mean, scale, weight): one row per fold and feature; weights are per standard deviation."""
    parts = F.arrays_zip(F.array(*[F.lit(c) for c in design.features]).alias("feature"),
                         F.col("model.means").alias("mean"), F.col("model.scales").alias("scale"),
                         F.col("model.weights").alias("weight"))
    return models.select("fold", F.explode(parts).alias("c")).select("fold", "c.*")


def predict(df: DataFrame, design: Design, models: DataFrame, out: str = "prediction") -> DataFrame:
    """The test rows of every fold with ``fold``, ``n_train`` and the prediction of the fold's model.

    A month is a test month of at most one fold, so rows are read once. The
    models join as k rows, the months as one row per month: bounds fixed by
    the fold count and the time span.
    """
    months = (df.where(F.col(design.label).isNotNull()).select(design.time_col)
              .where(F.col(design.time_col).isNotNull()).distinct()
              .withColumn("__pos", F.row_number().over(Window.orderBy(design.time_col))))
    spans = models.select("fold", "n_train", "model",
                          F.explode(F.sequence(F.col("first_test"), F.col("last_test"))).alias("__pos"))
    tagged = months.join(spans, "__pos").drop("__pos")
    rows = df.where(F.col(design.label).isNotNull()).join(F.broadcast(tagged), design.time_col)
    score = F.col("model.intercept")
    for i, c in enumerate(design.features):
        x = F.coalesce(null_nan(c), F.col("model.means")[i])
        score = score + F.col("model.weights")[i] * (x - F.col("model.means")[i]) / F.col("model.scales")[i]
    return rows.withColumn(out, score).drop("model")


def fold_scores(scored: DataFrame, label: str, prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """D12 per fold: fold, n_train, n_test, mae, rmse, r2 (against the mean of the fold's test labels), one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    err = y - p
    out = scored.groupBy("fold", "n_train").agg(
        F.count(F.lit(1)).alias("n_test"), F.avg(F.abs(err)).alias("a"), F.avg(err * err).alias("s"),
        F.var_pop(y).alias("v"))
    return out.select("fold", "n_train", "n_test", rnd("a", digits).alias("mae"), rnd(F.sqrt("s"), digits).alias("rmse"),
                      rnd(1 - F.try_divide("s", "v"), digits).alias("r2"))
