"""Calendar-aware panel features.

Lags and rolling means are equi-joins on ``(entity, month_index)`` rather
than windows partitioned by entity: a hot entity then spreads over its
months instead of landing in one task, and calendar gaps give NULL instead
of silently using an older row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd

from panelkit.functions.dates import weekday_mon0


def add_lags(df: DataFrame, keys: list[str], idx: str, cols: list[str], lags: list[int]) -> DataFrame:
    """``<c>_lag<k>`` = value of the same key ``k`` calendar months earlier."""
    out = df
    for k in lags:
        shifted = df.select(*keys, (F.col(idx) + k).alias(idx),
                            *[F.col(c).alias(f"{c}_lag{k}") for c in cols])
        out = out.join(shifted, on=[*keys, idx], how="left")
    return out


def rolling_mean(df: DataFrame, keys: list[str], idx: str, cols: list[str], n: int = 3,
                 digits: int | None = 4) -> DataFrame:
    """Mean of the previous ``n`` calendar months, current month excluded.

    Each row is fanned out to the ``n`` later months it contributes to (an
    ``n``-fold, not per-group, expansion), aggregated, and joined back.
    """
    ahead = F.explode(F.sequence(F.col(idx) + 1, F.col(idx) + n)).alias(idx)
    spread = df.select(*keys, ahead, *cols)
    r = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    means = spread.groupBy(*keys, idx).agg(*[r(F.avg(c)).alias(f"{c}_mean{n}") for c in cols])
    return df.join(means, on=[*keys, idx], how="left")


def year_over_year(df: DataFrame, keys: list[str], idx: str, cols: list[str],
                   digits: int | None = 4) -> DataFrame:
    """D3: ``(x - x_lag12) / x_lag12``; NULL when the base is 0 or missing."""
    lagged = add_lags(df, keys, idx, cols, [12])
    r = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    return lagged.withColumns({
        f"{c}_yoy": r(F.try_divide(F.col(c) - F.col(f"{c}_lag12"), F.col(f"{c}_lag12").cast("double")))
        for c in cols})


def conditional_counts(df: DataFrame, keys: list[str], conditions: dict[str, object],
                       distinct: dict[str, tuple] | None = None) -> DataFrame:
    """Per-key counts of rows meeting each condition (``count_if``) and,
    for ``distinct`` (name -> (column, condition)), of the different values
    among such rows; one pass and one grouping for all."""
    return df.groupBy(*keys).agg(
        *[F.count_if(c).alias(name) for name, c in conditions.items()],
        *[F.count_distinct(F.when(c, F.col(col))).alias(name) for name, (col, c) in (distinct or {}).items()])


def bridge_days(calendar: DataFrame, date_col: str = "date") -> DataFrame:
    """Monday before a Tuesday holiday, Friday after a Thursday holiday,
    unless that day is itself a holiday."""
    d = F.to_date(F.col(date_col))
    hol = calendar.select(d.alias("holiday")).distinct()
    cand = hol.select(
        F.when(weekday_mon0("holiday") == 1, F.date_sub("holiday", 1))
         .when(weekday_mon0("holiday") == 3, F.date_add("holiday", 1)).alias("bridge_day"),
        F.col("holiday").alias("because_of"))
    cand = cand.where(F.col("bridge_day").isNotNull())
    return cand.join(hol.withColumnRenamed("holiday", "bridge_day"), on="bridge_day", how="left_anti")


def completeness(df: DataFrame, year_col: str, month_col: str, expected: int = 12) -> DataFrame:
    """Years whose number of distinct months differs from ``expected``."""
    return (df.groupBy(year_col).agg(F.count_distinct(month_col).alias("months"))
              .where(F.col("months") != expected))


def stack_panels(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
