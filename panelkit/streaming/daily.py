"""Event stream -> watermark -> 1-day tumbling window -> daily table.

Production reads a Kafka topic (or a landing folder) and writes ``append``
mode: repeated events are dropped within the watermark, the watermark bounds
the state of both steps and closes a day once events are ``watermark`` past
it, and late rows behind the watermark are dropped. Every micro-batch goes to
a folder of its own, named by the batch id, so that a batch that runs again
after a failure replaces itself (:func:`append_daily`). The ``complete`` form
(:func:`run_daily_window`) keeps every day in its state and gives the whole
daily table at once. Tables and checkpoints lie under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import shared_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def _wall_clock_instant(c) -> "F.Column":
    """The instant whose UTC wall clock equals a ``timestamp_ntz`` value, so
    day windows (aligned to UTC midnight) follow the local calendar whatever
    the session time zone is."""
    return F.timestamp_micros(
        F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
        + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * F.lit(1_000_000)
        + (F.second(c).cast("bigint") * 1_000_000))


def daily_stream(stream: DataFrame, ts: str, keys: list[str], value: str,
                 watermark: str = "1 day", event_id: str | None = None) -> DataFrame:
    """Windowed daily aggregate of a stream: events and exact value total per
    (day, keys). ``withWatermark`` needs a ``timestamp`` (not NTZ) column; a
    local (NTZ) event time is mapped to the instant with the same UTC wall
    clock, and the day is read back in UTC, so the result does not depend on
    the session time zone.

    With ``event_id`` an event that is delivered again counts once: its id is
    remembered until the watermark passes it, after which a repeat is late
    anyway. Rows without an id are repeats only if all their columns are equal.
    """
    kind = dict(stream.dtypes).get(ts)
    t = _wall_clock_instant(F.col(ts)) if kind == "timestamp_ntz" else F.col(ts).cast("timestamp")
    s = stream.withColumn("__event_time", t).withWatermark("__event_time", watermark)
    if event_id:
        whole = F.sha2(F.to_json(F.struct(*stream.columns)), 256)
        s = s.withColumn("__row", F.when(F.col(event_id).isNull(), whole))
        s = s.dropDuplicatesWithinWatermark([event_id, "__row"])
    agg = s.groupBy(F.window("__event_time", "1 day").alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col(value).cast("decimal(18,2)")).alias("value_total"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
    return agg.select(day.alias("day"), *keys, "events",
                      F.col("value_total").cast("double").alias("value_total"))


def _file_stream(spark: SparkSession, path: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a folder, or over a single file."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files:
        reader = reader.option("maxFilesPerTrigger", str(files))
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(jvm_path).isFile():
        return reader.option("pathGlobFilter", jvm_path.getName()).load(jvm_path.getParent().toString())
    return reader.load(path)


def run_daily_window(spark: SparkSession, source_path: str, schema: T.StructType = EVENT_SCHEMA,
                     keys: list[str] | None = None, out_dir: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Run :func:`daily_stream` over a file source until all available input
    is processed, then return the written daily table as a batch DataFrame.

    Complete mode: the state holds one row per day and key, and every batch
    replaces the whole table.
    """
    stream = _file_stream(spark, source_path, schema, max_files_per_trigger)
    daily = daily_stream(stream, "ts", keys or ["event_type"], "value")
    base = out_dir or shared_path(spark, "stream_daily_window")
    target = f"{base}/table"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    q = (daily.writeStream.outputMode("complete").foreachBatch(write_batch)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    _finish(q)
    return spark.read.parquet(target)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def append_daily(source: DataFrame, base: str, keys: list[str] | None = None,
                 watermark: str = "1 day", event_id: str | None = "event_id", value: str = "value",
                 trigger: dict | None = None, state_partitions: int | None = None):
    """Append closed days of an event stream to ``<base>/table``; returns the finished or running query.

    A batch writes ``batch=<id>`` and nothing else, so writing it twice leaves
    one copy. Progress and state are under ``<base>/checkpoint``: a later call
    with the same ``base`` goes on where this one stopped. The default trigger
    processes what has arrived and stops. ``state_partitions`` sizes the state
    (Spark fixes it at the first start; default: the session's shuffle
    partitions) to the events of a watermark's span, not to the whole input.
    """
    spark = source.sparkSession
    daily = daily_stream(source, "ts", keys or ["event_type"], value, watermark, event_id)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={batch_id}")

    writer = (daily.writeStream.outputMode("append").foreachBatch(write_batch)
              .option("checkpointLocation", f"{base}/checkpoint").trigger(**(trigger or {"availableNow": True})))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
        query = writer.start()  # a query keeps the settings it was started with
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    if trigger is None:
        _finish(query)
    return query


def read_daily(spark: SparkSession, base: str) -> DataFrame:
    """The closed days that :func:`append_daily` has written."""
    return spark.read.parquet(f"{base}/table").drop("batch")


def start_daily_window(spark: SparkSession, source: DataFrame, sink_path: str, checkpoint: str,
                       keys: list[str] | None = None, watermark: str = "1 day",
                       trigger: dict | None = None):
    """Production form of D14: append mode, so each day is written once the
    watermark has passed it and its state is dropped; rows later than the
    watermark are ignored. ``source`` is any streaming DataFrame with the
    event schema (Kafka value parsed with ``from_json``, or a landing
    folder). Returns the running ``StreamingQuery``."""
    daily = daily_stream(source, "ts", keys or ["event_type"], "value", watermark)
    writer = (daily.writeStream.outputMode("append").format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"processingTime": "1 minute"}))
    return writer.start()
