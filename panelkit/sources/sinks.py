"""Sinks and catalog registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import schemas


def conform(df: DataFrame, ddl: str, strict: bool = True) -> DataFrame:
    """Project ``df`` onto a declared schema: cast every declared column and
    fail on unexpected columns (the reference's CSV writer raises on
    unexpected keys) when ``strict``."""
    target = schemas.struct(ddl)
    names = [f.name for f in target.fields]
    extra = [c for c in df.columns if c not in names]
    if strict and extra:
        raise ValueError(f"unexpected columns: {extra}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields]
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True,
                compression: str | None = "snappy", rows_per_file: int | None = None) -> None:
    """Write a table.

    CSV carries a header and quotes values where needed, doubling quotes, so
    that text with separators, quotes and line breaks comes back as it was; a
    NULL is an empty field, an empty text a quoted empty one. Parquet is Snappy-compressed.

    ``partition_by`` gives a partitioned layout (e.g. ``year, month`` or
    ``run_date``) that later reads prune. Rows are rebalanced by the partition
    columns first: a partition value comes to one task and so to one file,
    small values share tasks, and AQE cuts a hot value into as many tasks as
    its size asks for. ``rows_per_file`` bounds the rows of any file.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = (w.option("header", str(header).lower()).option("escape", '"').option("nullValue", "")
            .option("emptyValue", '""')
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if compression and fmt == "parquet":
        w = w.option("compression", compression)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def create_table_sql(name: str, location: str, ddl: str, fmt: str = "PARQUET",
                     partitioned_by: list[str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` over existing files with a declared schema."""
    cols = ",\n  ".join(f"`{c}` {t}" for c, t in schemas.columns(ddl))
    part = f"\nPARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    return (f"CREATE TABLE IF NOT EXISTS `{name}` (\n  {cols}\n) USING {fmt}{part}\n"
            f"LOCATION '{location}'")


def register_table(spark: SparkSession, name: str, location: str, ddl: str,
                   partitioned_by: list[str] | None = None) -> DataFrame:
    """Register files as a catalog table and return it."""
    spark.sql(create_table_sql(name, location, ddl, partitioned_by=partitioned_by))
    return spark.table(name)


def register_catalog(spark: SparkSession, root: str) -> list[str]:
    """Register every silver/gold table of :data:`panelkit.schemas.CATALOG` under ``root``."""
    done = []
    for name, (rel, ddl) in schemas.CATALOG.items():
        spark.sql(create_table_sql(name, f"{root.rstrip('/')}/{rel}", ddl))
        done.append(name)
    return done


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", num_partitions: int | None = None) -> None:
    """Publish a table to a relational store (overwrite load).

    ``num_partitions`` caps concurrent connections (``coalesce``); the
    driver class must be on the classpath. Not exercised offline.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=properties or {})


def write_versioned(df: DataFrame, path: str, run_date: str, fmt: str = "parquet") -> None:
    """One dataset version per run date (``run_date=<YYYY-MM-DD>``
    partition); earlier versions stay readable and are pruned by filters."""
    out = df.withColumn("run_date", F.lit(run_date).cast("date"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
        .partitionBy("run_date").save(path))
