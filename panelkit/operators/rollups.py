"""Group-by rollups (A1-A3).

All three are plain hash aggregations: Spark computes a partial aggregate
per input partition before the shuffle, so a hot key costs one row per
partition on the wire, not one row per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.numeric import exact_avg, exact_sum, null_nan, rnd


def monthly_rollup(df: DataFrame, keys: list[str], avg_cols: list[str], sum_cols: list[str],
                   count_as: str = "days", digits: int = 4,
                   decimal_scale: int | None = None, extra=None) -> DataFrame:
    """A1: daily -> monthly. ``count(*)`` rows, ``<c>_avg`` for averaged
    columns, ``<c>_total`` for summed ones; NULL/NaN skipped; all-NULL -> NULL.

    ``decimal_scale`` sums through DECIMAL so results do not depend on the
    order partitions are merged (use it for money-like doubles). ``extra``
    maps further output names to aggregate expressions computed in the same
    pass (e.g. conditional counts that later feed parent rollups).
    """
    aggs = [F.count(F.lit(1)).alias(count_as)]
    for c in avg_cols:
        x = null_nan(c)
        v = exact_avg(x, decimal_scale) if decimal_scale is not None else F.avg(x)
        aggs.append(rnd(v, digits).alias(f"{c}_avg"))
    for c in sum_cols:
        x = null_nan(c)
        v = exact_sum(x, decimal_scale) if decimal_scale is not None else F.sum(x)
        aggs.append(rnd(v, digits).alias(f"{c}_total"))
    aggs += [e.alias(n) for n, e in (extra or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def parent_rollup(df: DataFrame, keys: list[str], sum_cols: list[str],
                  count_as: str = "child_count") -> DataFrame:
    """A2: child rows -> parent key: one sum per metric and the child count.

    Children whose metrics are all zero still count (ledger L11).
    """
    aggs = [F.sum(c).alias(c) for c in sum_cols] + [F.count(F.lit(1)).alias(count_as)]
    return df.groupBy(*keys).agg(*aggs)


def scoped_counts(df: DataFrame, keys: list[str], scope_col: str, scopes: list[str],
                  count_as: str = "n") -> DataFrame:
    """A3: row counts per key for rows whose scope is in ``scopes``.

    The membership filter runs before the aggregate (and reaches the scan
    when ``scope_col`` is a stored column).
    """
    return (df.where(F.col(scope_col).isin(scopes))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)))
