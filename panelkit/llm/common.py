"""Helpers shared by the operators: shared-folder tables and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

BATCH_BYTES = 16 << 20  # text bytes handed to one Python step at a time


def work_dir(spark: SparkSession) -> str:
    """Folder for stored intermediate tables, under ``spark.checkpoint.dir``.

    The folder is read from the session. Only a local master, whose executors
    are this process, gets a temporary folder of its own where none is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-llm-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/panelkit_llm/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`work_dir`."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files, and later steps do not
    compute the table again.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the column ``text`` stays near BATCH_BYTES."""
    for batch in batches:
        size = batch.column(batch.schema.get_field_index(text)).nbytes
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(size, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_text(df: DataFrame, keep: list[str], text: str, fields: str,
             fn: Callable[[list], dict[str, list]]) -> DataFrame:
    """``keep`` columns plus the columns ``fn`` derives from the text column.

    ``fn`` gets the texts of a batch (None for null) and returns one list per
    column named in the DDL string ``fields``. Runs in Arrow batches.
    """
    base = df.select(*keep) if text in keep else df.select(*keep, text)
    made = StructType.fromDDL(fields)
    out = StructType([StructField(f.name, f.dataType) for f in df.select(*keep).schema.fields]
                     + made.fields)
    arrow = to_arrow_schema(out)
    names = made.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            got = fn(batch.column(batch.schema.get_field_index(text)).to_pylist())
            cols = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            cols = [c.cast(arrow.field(k).type) for k, c in zip(keep, cols)]
            cols += [pa.array(got[n], type=arrow.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return base.mapInArrow(run, out)


def bounded_sample(df: DataFrame, key, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer), chosen by the hash of ``key``.

    The share is taken from one count, so that no task or driver step orders
    the whole table; the choice does not depend on partitioning.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def sampled_texts(docs: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """The text and the marks of at most about ``rows`` marked documents, stored.

    ``marks`` has doc_id and further columns. The sample is drawn from the
    marks before any text is read, so its broadcast is bounded and no text is
    shuffled. Repeated ids count once where their marks agree and not at all
    where they differ; null ids do not count.
    """
    names = [c for c in marks.columns if c != "doc_id"]
    both = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(*names)).alias("a"), F.max(F.struct(*names)).alias("b"))
    marks = both.where(F.col("a").eqNullSafe(F.col("b"))).select("doc_id", "a.*")
    chosen = F.broadcast(bounded_sample(marks, F.col("doc_id"), rows))
    return stored(docs.select("doc_id", "text").join(chosen, "doc_id").drop("doc_id"), "labelled")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (one Parquet file or folder)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
