"""Readers for the driver tables (one Parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.session import shared_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHARED: dict[tuple[str, str, str], tuple[tuple, DataFrame]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Files of the driver tables with their sizes and times of change, as the file system lists them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return ()
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path))


def shared_table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """An intermediate table (silver/gold) materialized once per application and state of its inputs.

    The first use computes ``build()`` and writes it as Parquet under the
    cluster's shared ``spark.checkpoint.dir``; later uses read that table, as
    the analysis steps read the stored gold table. Lineage is cut (a lost
    executor re-reads files instead of recomputing joins), and reads get
    column pruning and filter pushdown. When the files in ``sf_dir`` change,
    the table is written anew.
    """
    key, state = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name), _state(spark, sf_dir)
    if key not in _SHARED or _SHARED[key][0] != state:
        path = shared_path(spark, name)
        build().write.parquet(path)
        _SHARED[key] = state, spark.read.parquet(path)
    return _SHARED[key][1]
