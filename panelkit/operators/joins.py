"""Joins and keyed selection.

Broadcast policy: only sides with a proven size are broadcast. By default
that proof is Spark's own: a side is broadcast when its size estimate (file
statistics, or AQE's measured shuffle output at run time) is below
``spark.sql.autoBroadcastJoinThreshold``; otherwise the join shuffles, and
AQE splits skewed partitions of a hot key. Literal dimensions and tables
bounded by construction are hinted explicitly where they are built.
``bounded_broadcast`` is the explicit opt-in when no estimate exists: it
checks the row count with a bounded ``limit(n+1).count()``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.text import normalize_text, strip_ws

DIM_MAX_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DIM_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows; above the bound the side is
    returned unchanged and joins through a shuffle.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def lookup(df: DataFrame, dim: DataFrame, on: list[str] | str, defaults: dict[str, Any] | None = None,
           max_dim_rows: int | None = None) -> DataFrame:
    """Left join to a dimension; missing values take ``defaults``.

    A default may be a literal or the name of a column of ``df`` (the
    reference falls back to the key itself). ``max_dim_rows`` forces a
    broadcast after a bounded row-count check; by default Spark's size-checked
    broadcast decides.
    """
    on = [on] if isinstance(on, str) else list(on)
    side = bounded_broadcast(dim, max_dim_rows) if max_dim_rows else dim
    out = df.join(side, on=on, how="left")
    for c, d in (defaults or {}).items():
        fill = F.col(d) if isinstance(d, str) and d in df.columns else F.lit(d)
        out = out.withColumn(c, F.coalesce(F.col(c), fill))
    return out


def unmapped(df: DataFrame, dim: DataFrame, on: list[str] | str, strict: bool = False) -> DataFrame:
    """Distinct keys of ``df`` missing from ``dim``.

    ``strict=True`` fails the job when any key is unmapped (bounded check:
    one row is enough to know).
    """
    on = [on] if isinstance(on, str) else list(on)
    keys = df.select(*on).distinct()
    missing = keys.join(dim.select(*on).distinct(), on=on, how="left_anti")
    if strict and missing.limit(1).count() > 0:
        sample = [tuple(r) for r in missing.limit(20).collect()]
        raise ValueError(f"unmapped keys (first 20): {sample}")
    return missing


def resolve_alias(df: DataFrame, col: str, aliases: DataFrame, canonical: DataFrame,
                  out: str | None = None) -> DataFrame:
    """Alias map -> accent-folded canonical name -> raw trimmed value.

    ``aliases(alias, target)`` is keyed by normalized alias text;
    ``canonical(name)`` lists canonical names. Blank input gives ``''``.
    When two canonical names fold to one key the smallest wins.
    """
    out = out or col
    key = "__alias_key"
    a = aliases.select(normalize_text("alias").alias(key), F.col("target").alias("__alias_target"))
    a = a.groupBy(key).agg(F.min("__alias_target").alias("__alias_target"))
    c = canonical.select(normalize_text("name").alias(key), F.col("name").alias("__canon"))
    c = c.groupBy(key).agg(F.min("__canon").alias("__canon"))
    res = (df.withColumn(key, normalize_text(col))
             .join(a, on=key, how="left")
             .join(c, on=key, how="left"))
    value = (F.when(F.col(key) == "", F.lit(""))
              .otherwise(F.coalesce("__alias_target", "__canon", strip_ws(col))))
    return res.withColumn(out, value).drop(key, "__alias_target", "__canon")


def drop_known(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Remove rows whose key already appears in ``known`` (left anti join)."""
    return df.join(known.select(*on).distinct(), on=on, how="left_anti")


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Keep rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys.select(*on).distinct(), on=on, how="left_semi")


HOT_KEY_ROWS = 1_000_000


def next_match(df: DataFrame, keys: list[str], order_col: str, is_match: Column, out: str,
               hot_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """For each row, the smallest ``order_col`` of a *matching* row of
    the same key that is strictly greater than its own (forward as-of match).

    ``order_col`` must be integral (e.g. ``unix_micros`` of a timestamp): the
    "strictly greater" frame is ``rangeBetween(1, unbounded)``. One window per
    key does it while no key has more than ``hot_rows`` rows (one counting
    aggregate tells); beyond that, :func:`_next_match_spread` cuts keys into
    range partitions. ``hot_rows=None`` is for keys that are bounded by
    construction and skips the count.
    """
    kind = dict(df.dtypes).get(order_col)
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"next_match needs an integral order column, got {order_col}: {kind}")
    o = F.col(order_col)
    if hot_rows is not None:
        most = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if most > hot_rows:
            return _next_match_spread(df, keys, order_col, is_match, out)
    w = Window.partitionBy(*keys).orderBy(o).rangeBetween(1, Window.unboundedFollowing)
    return df.withColumn(out, F.min(F.when(is_match, o)).over(w))


def _next_match_spread(df: DataFrame, keys: list[str], order_col: str, is_match: Column, out: str) -> DataFrame:
    """:func:`next_match` with every key cut by ``(key, order)`` ranges of about equal rows.

    The answer depends on key and order value alone, so distinct pairs are
    dealt to range partitions (stored, so that their bounds are data). A
    window inside each (partition, key) finds the near matches; matches in
    later partitions come from one row per (partition, key): the first match
    there, carried backwards. The answers join the rows by (key, order).
    """
    from panelkit.session import materialize

    staged = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    names = [f"__k{i}" for i in range(len(keys))]
    pairs = (df.select(*staged, F.col(order_col).alias("__o"), F.coalesce(is_match, F.lit(False)).alias("__m"))
             .groupBy(*names, "__o").agg(F.bool_or("__m").alias("__m")))
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialize(pairs.repartitionByRange(parts, *names, "__o").withColumn("__part", F.spark_partition_id()))
    match = F.when(F.col("__m"), F.col("__o"))
    inside = Window.partitionBy("__part", *names).orderBy("__o").rangeBetween(1, Window.unboundedFollowing)
    firsts = dealt.groupBy("__part", *names).agg(F.min(match).alias("__first"))
    after = Window.partitionBy(*names).orderBy("__part").rowsBetween(1, Window.unboundedFollowing)
    later = firsts.withColumn("__later", F.min("__first").over(after)).drop("__first")
    near = dealt.withColumn("__near", F.min(match).over(inside))
    same = lambda a, b: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    found = (near.alias("n").join(later.alias("l"), [F.col("n.__part") == F.col("l.__part"), *same("n", "l")])
             .select(*[F.col(f"n.{n}").alias(n) for n in names], F.col("n.__o").alias("__o"),
                     F.coalesce("n.__near", "l.__later").alias("__answer")))
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)] + [F.col(order_col).eqNullSafe(F.col("__o"))]
    return df.join(found, on, "left").withColumn(out, F.col("__answer")).drop(*names, "__o", "__answer")


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key ("last wins").

    ``max_by`` is an ordinary aggregate, so it is combined map-side and a hot
    key never buffers its rows in one task. ``order_cols`` must be unique
    within a key (add a tiebreak column) for a deterministic answer.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("__latest"))
    return picked.select(*keys, *[F.col("__latest")[c].alias(c) for c in rest])


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank_as: str = "rank") -> DataFrame:
    """First ``k`` rows per key under ``order`` (which must be unique).

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so each partition ships at most ``k`` rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_as, F.row_number().over(w)).where(F.col(rank_as) <= k)


@dataclass
class Side:
    """One left-joined side of a feature panel."""

    df: DataFrame
    on: list[str]
    columns: list[str]
    defaults: dict[str, Any] = field(default_factory=dict)
    rename: dict[str, str] = field(default_factory=dict)


def feature_panel(driver: DataFrame, sides: list[Side]) -> DataFrame:
    """The driver table, left outer joined to each side on its key.

    Rows of the driver are never dropped or duplicated as long as each
    side is unique on its key (ledger L25). Missing side values take the
    side's defaults (counts -> 0) or stay NULL.
    """
    out = driver
    for s in sides:
        cols = [F.col(c).alias(s.rename.get(c, c)) for c in s.columns]
        out = out.join(s.df.select(*s.on, *cols), on=s.on, how="left")
        for c, d in s.defaults.items():
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(d)))
    return out
