"""Data-quality and descriptive statistics.

Per-column statistics unpivot the table to ``(column, value)`` and group by
``column``, so many columns are summarised in one job and their final merges
run in parallel. Exact percentiles keep a value->count map per column;
``approx=True`` switches to ``percentile_approx`` (bounded sketch) for
high-cardinality columns at large scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.numeric import null_nan, rnd
from pyspark.sql import types as T

DESCRIBE_PERCENTILES = [0.05, 0.25, 0.5, 0.75, 0.95]


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans are not numeric)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def long_values(df: DataFrame, cols: list[str], name: str = "column", value: str = "value",
                keep_null: bool = False) -> DataFrame:
    """Unpivot ``cols`` to ``(column, value double)``; NaN is missing."""
    cast = df.select(*[null_nan(c).alias(c) for c in cols])
    out = cast.unpivot([], cols, name, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def _quantiles(x: Column, ps: list[float], approx: bool) -> Column:
    if approx:
        return F.percentile_approx(x, ps, 10000)
    return F.percentile(x, F.array(*[F.lit(p) for p in ps]))


def table_summary(df: DataFrame, key: str, time_col: str, target: str) -> DataFrame:
    """Rows, columns, distinct keys, month range, target present/missing."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.count_distinct(key).alias("key_count"),
        F.min(time_col).alias("min_time"),
        F.max(time_col).alias("max_time"),
        F.count(target).alias("target_non_null"),
        (F.count(F.lit(1)) - F.count(target)).alias("target_missing"),
    )


def _comparable(c: str, kind: str) -> Column:
    """A short string that is equal exactly where the column's values are; long values by their SHA-256."""
    x = F.col(c)
    if kind in ("float", "double"):
        x = x + F.lit(0.0)    # -0.0 is 0.0
    if kind.startswith(("array", "struct", "map", "variant")):
        x = F.when(x.isNotNull(), F.to_json(F.struct(x)))
    elif kind == "binary":
        x = F.hex(x)
    text = x.cast("string")
    return F.when(F.octet_length(text) > 64, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(F.concat(F.lit("="), text))


def column_profile(df: DataFrame, digits: int = 2, approx_distinct: bool = False) -> DataFrame:
    """Per column dtype, non-null, nulls, null % and distinct non-null count.

    Every row gives its (column position, value) pairs, which are counted
    map-side and meet in one shuffle by that pair, so wide tables, long texts
    and frequent values cost one row per task and distinct value. The dtype
    comes from the schema. ``approx_distinct`` uses HyperLogLog sketches
    instead (constant memory per column) for very large tables.
    """
    cols, dtypes = df.columns, dict(df.dtypes)
    about = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype")) for c in cols])
    if approx_distinct:
        wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"nn{i}") for i, c in enumerate(cols)],
                      *[F.approx_count_distinct(F.col(c)).alias(f"nd{i}") for i, c in enumerate(cols)])
        per = wide.select("rows", F.inline(F.array(*[F.struct(
            F.lit(i).alias("pos"), F.col(f"nn{i}").alias("non_null"), F.col(f"nd{i}").alias("unique"))
            for i in range(len(cols))])))
    else:
        pairs = df.select(F.posexplode(F.array(*[_comparable(c, dtypes[c]) for c in cols])).alias("pos", "value"))
        counts = pairs.groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
        per = counts.groupBy("pos").agg(
            F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
            F.count("value").alias("unique"))
        # an empty table has no pairs; its columns are listed all the same
        every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("pos"))
        per = every.join(per, "pos", "left").select("pos", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                                            for c in ("rows", "non_null", "unique")])
    return per.select("*", F.get(about, F.col("pos")).alias("a")).select(
        "pos", "a.column", "a.dtype", "non_null", (F.col("rows") - F.col("non_null")).alias("nulls"),
        rnd(F.try_divide((F.col("rows") - F.col("non_null")) * 100.0, F.col("rows")), digits).alias("null_pct"),
        "unique")


def describe_columns(df: DataFrame, cols: list[str], percentiles: list[float] | None = None,
                     approx: bool = False, digits: int | None = 6) -> DataFrame:
    """Count, mean, sample std, min, percentiles (linear), max per column.

    Exact percentiles come from :func:`quantiles.exact_quantiles` (distinct
    values range-partitioned, no column gathered in one task).
    """
    from panelkit.operators.quantiles import quantile_columns

    ps = percentiles or DESCRIBE_PERCENTILES
    names = [f"p{int(round(p * 100))}" for p in ps]
    r = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    long = long_values(df, cols)
    aggs = [F.count("value").alias("count"), F.avg("value").alias("__mean"),
            F.stddev_samp("value").alias("__std"), F.min("value").alias("min"), F.max("value").alias("max")]
    if approx:
        aggs.append(_quantiles(F.col("value"), ps, True).alias("__q"))
        stats = long.groupBy("column").agg(*aggs)
        stats = stats.select("*", *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    else:
        stats = long.groupBy("column").agg(*aggs).join(quantile_columns(long, "column", "value", ps, names),
                                                       "column", "left")
    return stats.select("column", "count", r(F.col("__mean")).alias("mean"), r(F.col("__std")).alias("std"),
                        "min", *[r(F.col(n)).alias(n) for n in names], "max")


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column, smallest on ties, NULL when empty.

    Two aggregations (per value, then per column), both combined map-side:
    no group is ever buffered whole.
    """
    counts = long_values(df, cols, keep_null=True).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    rank = F.struct(F.col("value").isNotNull(), F.when(F.col("value").isNotNull(), F.col("cnt")),
                    -F.col("value"))
    return counts.groupBy("column").agg(F.max_by("value", rank).alias("mode"))


def missing_summary(df: DataFrame) -> DataFrame:
    """A10: NULL (and NaN) count per column, only columns with missing values, descending."""
    floats = {c for c, t in df.dtypes if t in ("float", "double")}
    wide = df.agg(*[F.count_if((null_nan(c) if c in floats else F.col(c)).isNull()).alias(c)
                    for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "missing")
    return long.where(F.col("missing") > 0).orderBy(F.desc("missing"), "column")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first occurrence of each key (NULL keys equal)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"))


def quantile_bounds(df: DataFrame, cols: list[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Per column q1, q3 and Tukey fences ``q1 - k*iqr``, ``q3 + k*iqr``."""
    long = long_values(df, cols)
    if approx:
        q = long.groupBy("column").agg(_quantiles(F.col("value"), [0.25, 0.75], True).alias("__q"))
        q = q.select("column", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("q3"))
    else:
        from panelkit.operators.quantiles import quantile_columns
        q = quantile_columns(long, "column", "value", [0.25, 0.75], ["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lower_bound": F.col("q1") - k * iqr, "upper_bound": F.col("q3") + k * iqr})


def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5, approx: bool = False,
                 digits: int | None = None) -> DataFrame:
    """Values strictly outside the Tukey fences, counted per column.

    The bounds table has one row per column (size fixed by the column list),
    so it is broadcast back to the values.
    """
    bounds = quantile_bounds(df, cols, k, approx)
    vals = long_values(df, cols)
    joined = vals.join(F.broadcast(bounds), "column")
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    res = joined.groupBy("column", "lower_bound", "upper_bound").agg(F.count_if(out).alias("outliers"))
    if digits is not None:  # report rounded fences; the count used the exact ones
        res = res.withColumns({c: rnd(c, digits) for c in ("lower_bound", "upper_bound")})
    return res


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form, one aggregate.

    NaN is missing; a column that is constant over a pair's complete rows has
    no correlation (NULL).
    """
    pairs = [(a, b) for a in cols for b in cols]
    uniq = {}
    for a, b in pairs:
        key = tuple(sorted((a, b)))
        if key not in uniq:
            uniq[key] = f"c{len(uniq)}"
    def pearson(a: str, b: str) -> Column:
        x, y = null_nan(a), null_nan(b)
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    wide = df.agg(*[pearson(a, b).alias(n) for (a, b), n in uniq.items()])
    stack = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                               F.col(uniq[tuple(sorted((a, b)))]).alias("corr"))
                      for a, b in pairs])
    long = wide.select(F.inline(stack))
    return long.withColumn("corr", rnd("corr", digits))


def target_correlation(df: DataFrame, target: str, cols: list[str], digits: int = 6) -> DataFrame:
    """Correlation of every column with the target, descending."""
    m = correlation_matrix(df, [target] + [c for c in cols if c != target], digits)
    return (m.where(F.col("column_a") == target)
             .select(F.col("column_b").alias("column"), "corr")
             .orderBy(F.desc("corr"), "column"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins between min and max, last bin closed.

    min/max arrive through one scalar subquery (no cross join, nothing
    through the driver). NaN is missing.
    """
    x = null_nan(col)
    base = df.where(x.isNotNull()).select(x.alias("x"))
    rng = base.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    s = F.col("__s")
    width = (s["hi"] - s["lo"]) / F.lit(bins)
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - s["lo"]) / width), F.lit(bins - 1))).cast("int")
    counted = (base.withColumn("__s", rng).withColumn("bin", idx)
               .groupBy("bin", "__s").agg(F.count(F.lit(1)).alias("count")))
    return counted.select("bin",
                          (s["lo"] + F.col("bin") * width).alias("bin_start"),
                          (s["lo"] + (F.col("bin") + 1) * width).alias("bin_end"),
                          "count")


def boxplot_stats(df: DataFrame, col: str, k: float = 1.5, approx: bool = False,
                  digits: int | None = None) -> DataFrame:
    """Quartiles, whiskers (extreme points inside the fences), flier count. NaN is missing."""
    x = null_nan(col)
    base = df.where(x.isNotNull()).select(x.alias("x"))
    from panelkit.operators.quantiles import quantile_struct
    quart = quantile_struct(base, "x", [0.25, 0.5, 0.75], approx).scalar()
    base = base.withColumn("__q", quart)
    q = F.col("__q")
    q1, med, q3 = q[0], q[1], q[2]
    lo = q1 - k * (q3 - q1)
    hi = q3 + k * (q3 - q1)
    r = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    return base.agg(
        r(F.first(q1)).alias("q1"), r(F.first(med)).alias("median"), r(F.first(q3)).alias("q3"),
        F.min(F.when(F.col("x") >= lo, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= hi, F.col("x"))).alias("whisker_high"),
        F.count_if((F.col("x") < lo) | (F.col("x") > hi)).alias("fliers"),
        F.count(F.lit(1)).alias("n"),
    )


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of one column."""
    return df.select(col).distinct().orderBy(col)


def scatter_projection(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """P10: plotting projection with incomplete rows removed."""
    cols = [x, y] + ([hue] if hue else [])
    return df.select(*cols).dropna(subset=[x, y])


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """O3: first ``n`` rows under an explicit, unique order."""
    return df.orderBy(*order).limit(n)
