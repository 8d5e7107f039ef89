"""Baseline regression models and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """MAE, RMSE and R² in one aggregate (R² against the label mean).

    The label mean arrives as a scalar subquery so the whole thing is two
    distributed aggregates, no cross join.
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    base = df.where(y.isNotNull() & p.isNotNull())
    # The mean is attached once as a column (a scalar subquery may not sit
    # inside an aggregate when its plan holds non-deterministic model UDFs).
    base = base.withColumn("__mean", base.select(F.avg(y)).scalar())
    mean = F.col("__mean")
    err = y - p
    return base.agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.avg(F.abs(err)), digits).alias("mae"),
        rnd(F.sqrt(F.avg(err * err)), digits).alias("rmse"),
        rnd(1 - F.try_divide(F.sum(err * err), F.sum((y - mean) * (y - mean))), digits).alias("r2"),
    )


def fit_regressors(train: DataFrame, features: str, label: str, seed: int = 7, kinds: list[str] | None = None):
    """Ridge (L2), random forest and gradient-boosted trees, squared error."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    models = {
        "ridge": lambda: LinearRegression(featuresCol=features, labelCol=label, regParam=0.1, elasticNetParam=0.0),
        "random_forest": lambda: RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=30, maxDepth=5,
                                                       minInstancesPerNode=4, seed=seed),
        "gbt": lambda: GBTRegressor(featuresCol=features, labelCol=label, maxIter=12, maxDepth=3, stepSize=0.3,
                                    minInstancesPerNode=4, seed=seed),
    }
    return {name: models[name]().fit(train) for name in kinds or models}


def fixed_layout(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """The rows dealt by the hash of their (unique) keys and sorted.

    Tree fitting draws its bootstrap weights partition by partition; with this
    layout the draw, and so the model, depends on the rows alone and not on
    the files or shuffles they come from. ``partitions`` belongs to the model
    as the seed does: choose it for the data's size.
    """
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def tree_predictions(train: DataFrame, test: DataFrame, kind: str, label: str, keys: list[str],
                     numeric: list[str], categorical: list[str], partitions: int = 8, seed: int = 7) -> DataFrame:
    """``test`` with the ``prediction`` of a forest or of boosted trees fitted on ``train``.

    Spark's tree learners bin every feature into histograms, combine them per
    node over all partitions, and grow a level of all trees in one pass. Trees
    need no scaling, so the numeric columns are only imputed (with the train
    medians) and the categorical ones one-hot encoded. Sums of boosted trees
    may leave the labels seen in training; such predictions are moved to the
    nearest of them (a forest's averages never leave). ``train_min`` and
    ``train_max`` show that range.
    """
    from panelkit.operators import features as FE

    known = train.where(F.col(label).isNotNull())
    medians = FE.fit_medians(known, numeric)
    ready = lambda df: FE.fill_constant(FE.apply_medians(df, medians), categorical)
    rows = fixed_layout(ready(known), keys, partitions)
    prep = FE.build_preprocessor(numeric, categorical).fit(rows)
    model = fit_regressors(prep.transform(rows).withColumn(label, F.col(label).cast("double")), "features", label,
                           seed, [kind])[kind]
    ends = known.select(F.struct(F.min(label).cast("double").alias("lo"), F.max(label).cast("double").alias("hi"))).scalar()
    scored = model.transform(prep.transform(ready(test))).withColumn("__ends", ends)
    lo, hi = F.col("__ends")["lo"], F.col("__ends")["hi"]
    return (scored.withColumn("prediction", F.least(F.greatest("prediction", lo), hi))
            .withColumn("train_min", lo).withColumn("train_max", hi)
            .drop("__ends", "features", *[f"{c}__idx" for c in categorical], *[f"{c}__ohe" for c in categorical]))
