"""Exact quantiles by narrowing slices, without sorting or gathering a column.

``percentile`` merges a value->count map per group in a single task, which
for a high-cardinality column means one task holding every distinct value.
Here a first round counts the rows per order of magnitude (combined map-side,
so a task hands on at most one row per slice), and picks the slices that hold
the wanted ranks; each further round cuts only those, between their least and
greatest value, into ``CUTS`` equal parts. A first slice spans an eighth of a
per cent of a value, at most 2**43 different doubles, so two rounds of 2**22
parts leave one value per slice. No table in a task is larger than one round's
slices, whatever the data are like, and nothing runs while the plan is built.
The result is the same double as Spark's ``percentile``: ``pos = (n-1)*p``,
and ``(ceil(pos)-pos)*lo + (pos-floor(pos))*hi`` between the two neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 1 << 22     # parts of a slice
ROUNDS = 2         # after the first
PER_OCTAVE = 1024  # slices of the first round for each power of two


def magnitude(v: Column) -> Column:
    """A bigint that never falls as the double grows: the signed count of slices between zero and the value."""
    step = F.floor((F.log2(F.abs(v)) + F.lit(1076.0)) * F.lit(float(PER_OCTAVE)))
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, step).otherwise(-step)


def exact_quantiles(long: DataFrame, group: str, value: str, ps: list[float], cuts: int = CUTS) -> DataFrame:
    """Quantiles per ``group`` of the ``value`` column; NULL and NaN are left out.

    Returns ``(group, p, q)`` with one row per group and requested ``p``.
    Groups are meant to be columns, not entities: the wanted ranks (two per
    group and ``p``) are broadcast to each round after the first. ``cuts``
    bounds the slices of a round; fewer than ``CUTS`` take more rounds.
    """
    x = F.col(value).cast("double")
    rows = (long.select(F.col(group).alias("g"), x.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
            .withColumn("m", magnitude(F.col("v"))))
    ends = [F.count(F.lit(1)).alias("c"), F.min("v").alias("to_lo"), F.max("v").alias("to_hi")]
    counts = rows.groupBy("g", "m").agg(*ends)
    counts = counts.withColumns({"end": F.sum("c").over(Window.partitionBy("g").orderBy("m")),
                                 "n": F.sum("c").over(Window.partitionBy("g"))})
    # the two neighbouring ranks of every requested quantile
    sides = []
    for p in ps:
        pos = (F.col("n") - 1).cast("double") * F.lit(float(p))
        for name, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            sides.append(F.struct(F.lit(float(p)).alias("p"), pos.alias("pos"), F.lit(name).alias("side"),
                                  rank.alias("rank")))
    hits = _hits(counts.withColumn("wanted", F.array(*sides)))
    rounds, reach = 0, 1
    while reach < CUTS ** ROUNDS:
        rounds, reach = rounds + 1, reach * cuts
    for _ in range(rounds):
        slices = F.broadcast(hits.groupBy("g", "m", "lo", "hi").agg(
            F.collect_list(F.struct("p", "pos", "side", "rank")).alias("wanted")))
        inside = rows.join(slices.drop("wanted"), ["g", "m"]).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        # a slice's values differ by less than a factor of two, so the differences are exact
        part = F.when(F.col("hi") > F.col("lo"), F.floor(
            (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(cuts)))).otherwise(F.lit(0))
        counts = inside.groupBy("g", "m", "lo", "hi", part.alias("part")).agg(*ends)
        counts = counts.withColumn("end", F.sum("c").over(Window.partitionBy("g", "m", "lo", "hi").orderBy("part")))
        hits = _hits(counts.join(slices, ["g", "m", "lo", "hi"]))
    alone = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        F.raise_error(F.lit("a slice still holds several values")).cast("double"))
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("v")))
    picked = hits.withColumn("v", alone).groupBy("g", "p", "pos").agg(of("lo").alias("lo"), of("hi").alias("hi"))
    q = (F.when(F.col("lo") == F.col("hi"), F.col("lo"))
         .otherwise((F.ceil("pos").cast("double") - F.col("pos")) * F.col("lo")
                    + (F.col("pos") - F.floor("pos").cast("double")) * F.col("hi")))
    return picked.select(F.col("g").alias(group), "p", q.alias("q"))


def _hits(counts: DataFrame) -> DataFrame:
    """The wanted ranks with the ends of the part each falls into, counted on from the part's first row."""
    first = F.col("end") - F.col("c")
    inside = F.filter("wanted", lambda w: (w["rank"] >= first) & (w["rank"] < F.col("end")))
    return (counts.select("g", "m", "to_lo", "to_hi", first.alias("first"), F.explode(inside).alias("w"))
            .select("g", "m", F.col("to_lo").alias("lo"), F.col("to_hi").alias("hi"), "w.p", "w.pos", "w.side",
                    (F.col("w.rank") - F.col("first")).alias("rank")))


def quantile_struct(df: DataFrame, col: str, ps: list[float], approx: bool = False) -> DataFrame:
    """One-row DataFrame whose ``q`` is the array of quantiles of ``col``
    (one global group), exact by default."""
    x = F.col(col).cast("double")
    if approx:
        return df.select(F.percentile_approx(x, ps, 10000).alias("q"))
    qs = exact_quantiles(df.select(F.lit(0).alias("__g"), x.alias("__v")), "__g", "__v", ps)
    pairs = F.array_sort(F.collect_list(F.struct(F.col("p"), F.col("q"))))
    return qs.agg(F.transform(pairs, lambda e: e["q"]).alias("q"))


def quantile_columns(long: DataFrame, group: str, value: str, ps: list[float], names: list[str]) -> DataFrame:
    """Exact quantiles per group, one output column per requested ``p``."""
    qs = exact_quantiles(long, group, value, ps)
    return qs.groupBy(group).agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n)
                                   for p, n in zip(ps, names)])
