"""ML dataset preparation (F-C2, F4, M1-M6, P9, D13).

Statistics are fitted on the train rows only (ledger L18) and returned as a
one-row DataFrame; they are applied through a single scalar subquery that
returns a struct, so fitting never goes through the driver and applying
never needs a cross join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.numeric import null_nan, quantile_labels
from panelkit.session import shared_path


def quantile_bucket(df: DataFrame, col: str, labels: list[str], out: str,
                    approx: bool = False) -> DataFrame:
    """F-C2: quartile segments with interpolated edges over all rows."""
    from panelkit.operators.quantiles import quantile_struct

    n = len(labels)
    ps = [i / n for i in range(1, n)]
    x = F.col(col).cast("double")
    q = F.col("__q")
    staged = df.withColumn("__q", quantile_struct(df, col, ps, approx).scalar())
    return staged.withColumn(out, quantile_labels(x, [q[i] for i in range(n - 1)], labels)).drop("__q")


def month_table(df: DataFrame, time_col: str) -> DataFrame:
    """Distinct months with their 1-based chronological position.

    The table has one row per calendar month present (12 per year), a bound
    fixed by the time span, so ranking it in one task and broadcasting it
    back is safe at any row count.
    """
    months = df.select(time_col).where(F.col(time_col).isNotNull()).distinct()
    return months.withColumn("month_pos", F.row_number().over(Window.orderBy(time_col)))


def split_by_month(df: DataFrame, time_col: str, ratio: float = 0.8,
                   split_col: str = "split") -> DataFrame:
    """chronological split by whole months: the first ``floor(n*ratio)``
    distinct months are train, the rest test; no month is in both (L16)."""
    months = month_table(df, time_col)
    n = months.select(F.count(F.lit(1))).scalar()
    cut = F.floor(n * F.lit(ratio))
    labelled = months.select(time_col, F.when(F.col("month_pos") <= cut, F.lit("train"))
                             .otherwise(F.lit("test")).alias(split_col))
    return df.join(F.broadcast(labelled), on=time_col, how="inner")


def train_test(df: DataFrame, time_col: str, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    s = split_by_month(df, time_col, ratio, "__split")
    return (s.where(F.col("__split") == "train").drop("__split"),
            s.where(F.col("__split") == "test").drop("__split"))


def fit_medians(train: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """M1: exact (linear-interpolated) median per column on train rows.

    ``ml.Imputer`` returns a lower element (2.0 for 1..4), not the median.
    """
    if approx:
        return train.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(c) for c in cols])
    from panelkit.operators.profile import long_values
    from panelkit.operators.quantiles import exact_quantiles

    qs = exact_quantiles(long_values(train, cols), "column", "value", [0.5])
    one = qs.groupBy().agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in cols])
    return one.select(*[F.col(c).cast("double").alias(c) for c in cols])


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """M3: mean and *population* std per column; zero std -> 1."""
    aggs = []
    for c in cols:
        x = null_nan(c)
        aggs.append(F.avg(x).alias(f"{c}__mean"))
        sd = F.stddev_pop(x)
        aggs.append(F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"{c}__std"))
    return train.agg(*aggs)


def with_stats(df: DataFrame, stats: DataFrame, name: str = "__stats") -> DataFrame:
    """Attach fitted statistics as one struct column.

    The struct comes from a single scalar subquery referenced once, so the
    statistics plan appears once in the query (referencing the subquery per
    column would copy the fitting plan into every expression).
    """
    return df.withColumn(name, stats.select(F.struct(*stats.columns)).scalar())


def apply_medians(df: DataFrame, medians: DataFrame) -> DataFrame:
    s = F.col("__med")
    out = with_stats(df, medians, "__med")
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), s[c]) for c in medians.columns}).drop("__med")


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: list[str]) -> DataFrame:
    s = F.col("__scale")
    out = with_stats(df, scaler, "__scale")
    return out.withColumns({c: (F.col(c).cast("double") - s[f"{c}__mean"]) / s[f"{c}__std"]
                            for c in cols}).drop("__scale")


def fill_constant(df: DataFrame, cols: list[str], value: str = "unknown") -> DataFrame:
    """M2: constant imputation for categoricals."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in cols})


def ranked(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rows of a one-row-per-value table with the value's 0-based rank, without a sort in one task.

    Values are dealt to range partitions and stored; a value's rank is its
    place within its partition plus the sizes of the partitions before it (one
    small row per partition).
    """
    from panelkit.session import materialize

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.repartitionByRange(parts, col).sortWithinPartitions(col)
             .withColumn("__part", F.spark_partition_id())
             .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    dealt = materialize(dealt)
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (dealt.join(F.broadcast(offsets), "__part").withColumn(out, F.col("__before") + F.col("__place"))
            .drop("__part", "__place", "__before"))


def category_index(train: DataFrame, col: str) -> DataFrame:
    """M4 (fit): sorted train categories with their 0-based slot, one row per category."""
    cats = train.select(F.col(col).alias("category")).where(F.col("category").isNotNull()).distinct()
    return ranked(cats, "category", "slot")


def one_hot_slot(df: DataFrame, train: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """M4 (apply): active slot among sorted train categories, NULL when the
    value was unseen (all-zero row), and the encoding width.

    The categories join by value; Spark broadcasts them only where their
    measured size allows it.
    """
    p = prefix or col
    idx = category_index(train, col)
    width = idx.select(F.count(F.lit(1))).scalar()
    joined = df.join(idx.withColumnRenamed("category", col), on=col, how="left")
    return joined.withColumnRenamed("slot", f"{p}_slot").withColumn(f"{p}_width", width)


def model_columns(df: DataFrame, exclude: list[str]) -> DataFrame:
    """Drop leakage-prone or auxiliary columns."""
    return df.drop(*[c for c in exclude if c in df.columns])


def build_preprocessor(numeric: list[str], categorical: list[str], output: str = "features"):
    """M5: one-hot (all train categories, unseen -> zeros, sorted) + assembly.

    Numeric columns must already be imputed/scaled with the exact train
    statistics above (``ml.Imputer``/``ml.StandardScaler`` differ: lower
    median, sample std). Returns an unfitted ``pyspark.ml.Pipeline``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    stages = [
        StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        # The indexer puts unseen values in slot n; dropLast removes exactly that
        # slot, so unseen rows encode as all zeros.
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=numeric + ohe, outputCol=output, handleInvalid="keep"),
    ]
    return Pipeline(stages=stages)


def feature_names(model, numeric: list[str], categorical: list[str]) -> list[str]:
    """Output column names of a fitted :func:`build_preprocessor` (M5/M6)."""
    indexer = model.stages[0]
    names = list(numeric)
    for c, labels in zip(categorical, indexer.labelsArray):
        names.extend(f"{c}_{v}" for v in labels)
    return names


@dataclass(frozen=True)
class Preparation:
    """M1-M5 as one fitted object: medians, scales, one-hot and assembly, learnt from train rows only.

    ``stats`` is a one-row table (a median, mean and scale per numeric
    column), ``model`` the fitted Spark ML pipeline. :meth:`save` keeps both
    in one folder, :meth:`load` reads them back, in another application too.
    """

    numeric: list[str]
    categorical: list[str]
    stats: DataFrame
    model: object

    @classmethod
    def fit(cls, train: DataFrame, numeric: list[str], categorical: list[str]) -> Preparation:
        medians = fit_medians(train, numeric)
        filled = apply_medians(train, medians)
        scales = fit_scaler(filled, numeric)
        # One row; stored, since fitting the medians takes several passes that no later step should repeat.
        both = F.struct(medians.select(F.struct(*medians.columns)).scalar().alias("median"),
                        scales.select(F.struct(*scales.columns)).scalar().alias("scale"))
        path = shared_path(train.sparkSession, "preparation-stats")
        train.sparkSession.range(1).select(both.alias("s")).select("s.*").write.parquet(path)
        stats = train.sparkSession.read.parquet(path)
        fitted = cls(numeric, categorical, stats, None)
        return replace(fitted, model=build_preprocessor(numeric, categorical).fit(fitted._numbers(train)))

    def _numbers(self, df: DataFrame) -> DataFrame:
        """Numeric columns imputed and scaled, categorical ones filled."""
        filled = apply_medians(df, self.stats.select("median.*"))
        return fill_constant(apply_scaler(filled, self.stats.select("scale.*"), self.numeric), self.categorical)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector column ``features``; unseen categories are all zeros."""
        return self.model.transform(self._numbers(df))

    @property
    def names(self) -> list[str]:
        return feature_names(self.model, self.numeric, self.categorical)

    def save(self, path: str) -> None:
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        from pyspark.ml import PipelineModel

        stats, model = spark.read.parquet(f"{path}/stats"), PipelineModel.load(f"{path}/model")
        return cls(list(stats.schema["median"].dataType.names), list(model.stages[0].getInputCols()), stats, model)


def prepare_matrix(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str]):
    """M1-M6 end to end: returns ``(train_x, test_x, names)`` with a ``features``
    vector column; statistics come from ``train`` only."""
    made = Preparation.fit(train, numeric, categorical)
    return made.transform(train), made.transform(test), made.names


def named_features(df: DataFrame, names: list[str], keep: list[str], features: str = "features") -> DataFrame:
    """M6: the vector column as rows (``keep`` columns, feature, value), one per feature of ``names``."""
    from pyspark.ml.functions import vector_to_array

    label = F.array(*[F.lit(n) for n in names])
    return df.select(*keep, F.posexplode(vector_to_array(F.col(features))).alias("__at", "value")).select(
        *keep, F.get(label, F.col("__at")).alias("feature"), "value")


def expanding_folds(df: DataFrame, time_col: str, k: int) -> DataFrame:
    """``k`` expanding-window folds over whole months.

    With ``n`` months and ``size = n // (k+1)``, fold ``f`` (1..k) trains on
    months ``1..f*size`` and tests on ``f*size+1..(f+1)*size`` (the last fold
    tests up to month ``n``). Returns the rows tagged ``(fold, role)``; each
    row appears in at most ``k`` folds.
    """
    months = month_table(df, time_col)
    n = months.select(F.count(F.lit(1))).scalar()
    size = F.floor(n / F.lit(k + 1))
    folds = F.array(*[F.lit(f) for f in range(1, k + 1)])
    pos = F.col("month_pos")
    tagged = months.select(time_col, pos, F.explode(folds).alias("fold"))
    role = (F.when(pos <= F.col("fold") * size, F.lit("train"))
             .when((pos <= (F.col("fold") + 1) * size) | ((F.col("fold") == k) & (pos <= n)), F.lit("test")))
    tagged = tagged.withColumn("role", role).where(F.col("role").isNotNull()).drop("month_pos")
    return df.join(F.broadcast(tagged), on=time_col, how="inner")


def preview(df: DataFrame, names: list[str], n: int = 5, order: list[str] | None = None,
            features: str = "features", keep: list[str] | None = None) -> DataFrame:
    """M6: the first ``n`` prepared rows with one named column per feature
    (``vector_to_array`` keeps the work on the executors)."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(features))
    base = df.orderBy(*order).limit(n) if order else df.limit(n)
    return base.select(*(keep or []), *[arr[i].alias(name) for i, name in enumerate(names)])
