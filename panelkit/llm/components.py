"""Connected components of a link table, by contraction joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(doc_id, component_id): the smallest id reachable, for every id in a link.

    Each round points every vertex at its smallest neighbour, follows the
    pointers to their roots, and replaces link ends by the roots; links inside
    a component vanish. At least half of the linked vertices disappear per
    round. Every step is a join or a partial aggregate, so a hub with any
    number of links is pre-aggregated (or split by the skew join). Null ends
    and self links are ignored; an empty link table gives an empty result.
    """
    edges = stored(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                   .where("u < v").distinct(), "edges")
    roots: DataFrame | None = None
    while roots is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        point = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("p")), "pointers")
        point = _follow(point)
        root_u = point.select("u", F.col("p").alias("pu"))
        root_v = point.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = stored(edges.join(root_u, "u").join(root_v, "v").where("pu <> pv")
                       .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
                       .distinct(), "edges")
        if roots is None:
            roots = point
        else:
            nxt = point.select(F.col("u").alias("p"), F.col("p").alias("q"))
            roots = stored(roots.join(nxt, "p", "left")
                           .select("u", F.coalesce("q", "p").alias("p")), "roots")
    return roots.select(F.col("u").alias("doc_id"), F.col("p").alias("component_id"))


def _follow(point: DataFrame) -> DataFrame:
    """Pointer jumping until every vertex points at a root."""
    while True:
        nxt = point.select(F.col("u").alias("p"), F.col("p").alias("q"))
        moved = point.join(nxt, "p").where("q <> p")
        if moved.isEmpty():
            return point
        point = stored(point.join(nxt, "p").select("u", F.col("q").alias("p")), "pointers")
