"""One run from raw files to the catalogue: bronze -> silver -> gold -> registered tables.

The raw files are landed from the driver tables in the reference's formats:
JSON documents of parallel arrays (daily observations), a semicolon CSV
(target statistics), and workbook cells (shipments by supplier and month).
Everything after :func:`land` reads only those files and the dimensions, and
every layer is written and read again, so a step that fails can be repeated
from the layer below it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit import schemas
from panelkit.functions.text import normalize_entity_name
from panelkit.operators import grid as G
from panelkit.operators.joins import Side, feature_panel, lookup
from panelkit.operators.profile import duplicate_count
from panelkit.operators.rollups import parent_rollup
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import with_blocks
from panelkit.plans.q_grid import render_cells
from panelkit.plans.registry import register
from panelkit.plans.tables import table
from panelkit.session import shared_path
from panelkit.sources.files import explode_parallel_arrays
from panelkit.sources.readers import read_csv_utf8_or_latin1
from panelkit.sources.sinks import conform, create_table_sql, write_table

ORDERS_PER_DOCUMENT = 100_000   # order keys that one raw document spans
METRICS = ["ship_qty", "ship_lines", "ship_value"]

DAILY = "order_key bigint, day string, priority string, status string, price double, price_n double"


def raw_daily() -> T.StructType:
    """Schema of a raw document: place names and one array per daily column."""
    columns = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in schemas.struct(DAILY).fields]
    return T.StructType([T.StructField("entity", T.StringType()), T.StructField("region", T.StringType()),
                         T.StructField("daily", T.StructType(columns))])


# Layer tables: name -> DDL (the gold table's is the panel's own schema).
SILVER = {
    "monthly": "entity string, region string, year_month string, days bigint, price_avg double, price_n_avg double, "
               "price_total double, price_n_total double",
    "calendar": "year_month string, region_code string, n bigint",
    "shipments": "entity string, year_month string, ship_qty bigint, ship_lines bigint, ship_value bigint, "
                 "supplier_count bigint",
    "target": "entity string, year_month string, target_lines double, target_qty double, target_avg_qty double, "
              "target_discount_avg double",
}
GOLD = ", ".join(f"{name} {kind}" for name, kind in P.PANEL_SCHEMA)


def land(spark: SparkSession, sf_dir: str, bronze: str) -> None:
    """Write the raw files."""
    daily = P.daily(spark, sf_dir)
    fields = [f.name for f in schemas.struct(DAILY).fields]
    row = F.struct(*[(F.col(c).cast("string") if c == "day" else F.col(c)).alias(c) for c in fields])
    documents = (daily.groupBy("entity", "region", "year_month", F.expr(f"order_key div {ORDERS_PER_DOCUMENT}").alias("k"))
                 .agg(F.collect_list(row).alias("rows")))
    documents.select("entity", "region", F.struct(*[F.col("rows").getField(c).alias(c) for c in fields])
                     .alias("daily")).write.option("ignoreNullFields", "false").json(f"{bronze}/daily")
    target = P.target_side(spark, sf_dir).withColumns({"AÑO": F.substring("year_month", 1, 4),
                                                       "MES": F.substring("year_month", 6, 2)}).drop("year_month")
    target.write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1").csv(f"{bronze}/target")
    write_table(render_cells(spark, sf_dir), f"{bronze}/workbooks")


def silver(spark: SparkSession, sf_dir: str, bronze: str, root: str) -> None:
    """Parse the raw files into the silver tables."""
    documents = spark.read.schema(raw_daily()).option("mode", "FAILFAST").json(f"{bronze}/daily")
    rest = [f.name for f in schemas.struct(DAILY).fields if f.name != "order_key"]
    daily = explode_parallel_arrays(documents, "daily", "order_key", rest, keep=["entity", "region"])
    daily = daily.withColumns({"day": F.to_date("day"), "year_month": F.substring("day", 1, 7)})
    from panelkit.operators.rollups import monthly_rollup

    write(monthly_rollup(daily, ["entity", "region", "year_month"], avg_cols=["price", "price_n"],
                         sum_cols=["price", "price_n"], count_as="days", digits=4, decimal_scale=2), root, "monthly")
    write(P.calendar_counts(daily), root, "calendar")

    cells = spark.read.parquet(f"{bronze}/workbooks")
    tidy = G.tidy_table(cells).withColumn("year_month", F.regexp_extract("source_file", r"(\d{4}-\d{2})", 1))
    suppliers = table(spark, sf_dir, "supplier").select(normalize_entity_name("s_name").alias("entity_name"), "s_nationkey")
    named = F.regexp_replace("entity_name", "^SUPPLIER#", "SUPPLIER-")
    places = lookup(suppliers.withColumn("entity_name", named),
                    P.entity_dim(spark, sf_dir).withColumnRenamed("nationkey", "s_nationkey"), "s_nationkey")
    months = tidy.join(places, "entity_name").withColumnsRenamed(dict(zip(G.METRICS, METRICS)))
    write(parent_rollup(months, P.PANEL_KEYS, METRICS, count_as="supplier_count"), root, "shipments")

    raw = read_csv_utf8_or_latin1(spark, f"{bronze}/target")
    write(raw.withColumn("year_month", F.concat_ws("-", "AÑO", "MES")).drop("AÑO", "MES", "source_file"), root, "target")


def write(df: DataFrame, root: str, name: str) -> None:
    write_table(conform(df, SILVER[name]), f"{root}/silver/{name}")


def gold(spark: SparkSession, root: str) -> None:
    """Integrate the silver tables; a repeated key fails the run before the table is written."""
    read = lambda name: spark.read.schema(schemas.struct(SILVER[name])).parquet(f"{root}/silver/{name}")
    counts = read("calendar")
    national = counts.where(F.col("region_code") == P.GLOBAL_SCOPE_KEY).select(
        "year_month", F.col("n").alias("national_count"))
    regional = counts.where(F.col("region_code") != P.GLOBAL_SCOPE_KEY).select(
        "year_month", F.col("region_code").alias("region"), F.col("n").alias("regional_count"))
    shipped = [*METRICS, "supplier_count"]
    panel = feature_panel(read("monthly"), [
        Side(national, ["year_month"], ["national_count"], {"national_count": 0}),
        Side(regional, ["year_month", "region"], ["regional_count"], {"regional_count": 0}),
        Side(read("shipments"), P.PANEL_KEYS, shipped, dict.fromkeys(shipped, 0)),
        Side(read("target"), P.PANEL_KEYS, ["target_lines", "target_qty", "target_avg_qty", "target_discount_avg"])])
    panel = panel.withColumnsRenamed({"region": "region_code"}).withColumns({
        "total_count": F.col("national_count") + F.col("regional_count"),
        "target_available": F.col("target_qty").isNotNull(), "feature_source": F.lit(P.FEATURE_SOURCE)})
    path = f"{root}/gold/panel"
    write_table(conform(panel, GOLD), path)
    if duplicate_count(spark.read.parquet(path), P.PANEL_KEYS).first()[0]:
        raise ValueError("the gold table repeats a key")


def register_lake(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Catalogue every silver and gold table below ``root`` under ``prefix``; returns the names."""
    names = {f"{prefix}_silver_{n}": (f"silver/{n}", ddl) for n, ddl in SILVER.items()}
    names[f"{prefix}_gold_panel"] = ("gold/panel", GOLD)
    for name, (place, ddl) in names.items():
        spark.sql(create_table_sql(name, f"{root}/{place}", ddl))
    return list(names)


def run_lake(spark: SparkSession, sf_dir: str, root: str, prefix: str) -> list[str]:
    """The whole run; returns the names of the registered tables."""
    land(spark, sf_dir, f"{root}/bronze")
    silver(spark, sf_dir, f"{root}/bronze", root)
    gold(spark, root)
    return register_lake(spark, root, prefix)


@register("lake_gold_panel", with_blocks("SELECT * FROM panel", "panel"))
def lake_gold_panel(spark, sf):
    """The gold table of a whole run, read by SQL from the catalogue."""
    prefix = f"panelkit_{uuid.uuid4().hex}"
    names = run_lake(spark, sf, shared_path(spark, "lake"), prefix)
    out = spark.sql(f"SELECT * FROM {prefix}_gold_panel")
    for name in names:   # the entries only: the result reads the files they named
        spark.sql(f"DROP TABLE {name}")
    return out
