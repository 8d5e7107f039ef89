"""Session construction and cluster-wide settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every panelkit job relies on. AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is small, skew-join splitting
# for hot keys, partition coalescing); the session time zone is pinned so
# month keys derived from timestamps never depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "panelkit",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with panelkit's defaults.

    ``master`` is only set when given, so on a cluster the launcher's master
    wins. ``shuffle_partitions`` defaults to Spark's own value; size it to the
    data (roughly input bytes / 128 MB) on a cluster, and to the core count
    for local tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, installed as the context's checkpoint folder.

    On a cluster the setting must be there and is used as is. Only a local
    master, whose executors are this process, gets a folder of its own where
    none is set: ``fallback``, or a new temporary one.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = fallback or tempfile.mkdtemp(prefix="panelkit-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/panelkit/{label}-{uuid.uuid4().hex}"


def materialize(df):
    """Compute a table once and cut its lineage: a reliable ``checkpoint()`` in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, label: str):
    """Write a table as Parquet into the shared folder and read it back: computed once, lineage cut."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
