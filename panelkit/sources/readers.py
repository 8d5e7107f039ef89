"""Text-file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import schemas
from panelkit.sources.files import looks_like_semicolon_csv


def read_csv_strings(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8",
                     header: bool = True) -> DataFrame:
    """S3: header CSV, every column as a string (no inference).

    Quoted fields may hold line breaks and doubled quotes; an empty field is
    NULL, a quoted empty one the empty string. All files must
    have the same header; another one fails the read instead of shifting
    columns.
    """
    return (_csv(spark, path, sep, encoding, header)
            .select("*", F.col("_metadata.file_name").alias("source_file")))


def _csv(spark: SparkSession, path: str | list[str], sep: str, encoding: str, header: bool = True) -> DataFrame:
    return (spark.read.option("header", str(header).lower()).option("inferSchema", "false")
            .option("enforceSchema", "false").option("sep", sep).option("encoding", encoding)
            .option("nullValue", "\u0000").option("emptyValue", "")  # an empty field reads as the first, "" as the second
            .option("multiLine", "true").option("quote", '"').option("escape", '"').csv(path))


def probe_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, encoding, header, semicolon_csv) of every text file, from one distributed scan.

    A file is UTF-8 if all its lines are valid UTF-8, else Latin-1; the header
    is its first line in that encoding without a byte order mark, and
    ``semicolon_csv`` tells whether the header names the columns expected of a
    semicolon file. Empty files have no row.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line")).alias("place"))
    files = lines.groupBy("file_path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
                                           F.min_by("value", "place").alias("first"))
    header = F.when(F.col("utf8"), F.col("first")).otherwise(F.decode(F.col("first").cast("binary"), "ISO-8859-1"))
    return files.select("file_path", F.when(F.col("utf8"), F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1")).alias("encoding"),
                        F.regexp_replace(header, "^\ufeff|\r$", "").alias("header")
                        ).withColumn("semicolon_csv", looks_like_semicolon_csv("header"))


def _read_files(spark: SparkSession, files: list, sep: str) -> DataFrame:
    """The files of one header, each in its own encoding."""
    parts = []
    for encoding in ("UTF-8", "ISO-8859-1"):
        if paths := sorted(f["file_path"] for f in files if f["encoding"] == encoding):
            parts.append(read_csv_strings(spark, paths, sep=sep, encoding=encoding))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_csv_utf8_or_latin1(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Semicolon CSV decoded as UTF-8, falling back to Latin-1 for files
    that are not valid UTF-8.

    The decision is per file, by full path (:func:`probe_csv`). The paths come
    to the driver, where Spark's own file listing already is. All files must
    have one header, whatever their encoding; others fail the read (see
    :func:`read_csv_by_header`).
    """
    files = probe_csv(spark, path).collect()
    headers = sorted({f["header"] for f in files})
    if len(headers) > 1:
        raise ValueError(f"{len(headers)} different headers below {path}, such as {headers[:3]}")
    return _read_files(spark, files, sep) if files else read_csv_strings(spark, path, sep=sep)


def read_csv_by_header(spark: SparkSession, path: str, sep: str = ";") -> dict[str, DataFrame]:
    """Header -> rows of the semicolon files below ``path`` that have it; files without such a header are left out."""
    groups: dict[str, list] = {}
    for f in probe_csv(spark, path).where("semicolon_csv").collect():
        groups.setdefault(f["header"], []).append(f)
    return {header: _read_files(spark, files, sep) for header, files in sorted(groups.items())}


def read_manifests(spark: SparkSession, path: str, suffix: str = ".metadata.json") -> DataFrame:
    """Landing manifests (one JSON document per download) with a fixed schema."""
    return (spark.read.schema(schemas.struct(schemas.LANDING_MANIFEST)).option("multiLine", "true")
            .option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").json(path))
