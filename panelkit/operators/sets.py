"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def key_union(dfs: list[DataFrame]) -> DataFrame:
    """Distinct union of key sets."""
    return union_all(dfs).distinct()


def key_except(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested keys that are not known (set difference, distinct)."""
    return requested.distinct().subtract(known.distinct())


def key_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: keys present in both."""
    return a.distinct().intersect(b.distinct())
