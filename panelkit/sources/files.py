"""File-side operators (S1-S13, S19): scans, file-name fields, inventories,
payload sniffing/validation, incremental plans and request plans.

Files are read with Spark's own sources (``json``, ``csv``, ``binaryFile``,
``parquet``); per-file facts come from the hidden ``_metadata`` column, so
every operator is a projection or aggregate over ordinary rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd
from pyspark.sql import types as T

from panelkit.functions.text import _col

# File-name patterns of the monthly workbooks and the weather
# downloads, and the magic-byte rules of the payload sniffer.
MONTH_PATTERN = r"^(\d{2})[._]"
YEAR_PATTERN = r"(20\d{2})"
LOCATION_PATTERN = r"^(.+?)_\d{8}_\d{8}"
CSV_SNIFF_BYTES = 2048
CSV_HEADER_WORDS = ["AÑO", "MES"]
ASCII_WS = "[ \\t\\n\\r\\x0b\\x0c]"


def _extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    v = F.regexp_extract(c, pattern, group)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def file_fields(name, strict: bool = False) -> dict[str, Column]:
    """month = leading ``\\d{2}[._]``, year = first ``20\\d{2}`` of a file
    name. ``strict`` fails the job on an unparsable name, as the reference does."""
    n = _col(name)
    month = _extract_or_null(n, MONTH_PATTERN).cast("int")
    year = _extract_or_null(n, YEAR_PATTERN).cast("int")
    if strict:
        bad = month.isNull() | year.isNull()
        month = F.when(bad, F.raise_error(F.concat(F.lit("cannot parse month/year from "), n))).otherwise(month)
    return {"file_year": year, "file_month": month}


def location_code(name) -> Column:
    """Location code = text before ``_<YYYYMMDD>_<YYYYMMDD>``; the
    reference's split on ``_201`` breaks for ranges starting in 2020+."""
    return _extract_or_null(_col(name), LOCATION_PATTERN)


def with_file_fields(df: DataFrame, name_col: str, strict: bool = False) -> DataFrame:
    return df.withColumns(file_fields(name_col, strict))


def read_with_file_name(spark: SparkSession, fmt: str, path: str, schema=None, **options) -> DataFrame:
    """Read any file source and add ``source_file`` from ``_metadata``."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def file_inventory(spark: SparkSession, path: str, exclude_suffix: str = ".metadata.json",
                   recursive: bool = True) -> DataFrame:
    """Name, lower-case suffix, bytes, modification time of every file.

    ``content`` is never selected, so the binary source does not read file
    bodies (column pruning).
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
          .load(path).select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    out = df.select(
        name.alias("file_name"),
        F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)).alias("suffix"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.col("path"),
    )
    return out.where(~F.col("file_name").endswith(exclude_suffix))


def reconcile_manifests(inventory: DataFrame, manifests: DataFrame, key: str) -> DataFrame:
    """Landed files against their manifests, by ``key`` (a column of both).

    ``inventory`` has bytes and suffix, ``manifests`` bytes_written and
    detected_format. Full outer join; ``status`` is ``missing_file``,
    ``missing_manifest``, ``size_differs``, ``suffix_differs`` or ``ok``, the
    first that holds. A null key matches nothing; repeated manifests of one
    key are compared one by one.
    """
    files = inventory.select(F.col(key).alias("__file"), "bytes", "suffix")
    told = manifests.select(F.col(key).alias("__told"), F.col("bytes_written").alias("declared_bytes"),
                            F.lower("detected_format").alias("declared_suffix"))
    both = files.join(told, F.col("__file") == F.col("__told"), "full_outer")
    status = (F.when(F.col("__file").isNull() & F.col("bytes").isNull(), F.lit("missing_file"))
              .when(F.col("__told").isNull(), F.lit("missing_manifest"))
              .when(~F.col("bytes").eqNullSafe(F.col("declared_bytes")), F.lit("size_differs"))
              .when(~F.col("suffix").eqNullSafe(F.col("declared_suffix")), F.lit("suffix_differs"))
              .otherwise(F.lit("ok")))
    return both.select(F.coalesce("__file", "__told").alias(key), "bytes", "declared_bytes", "suffix",
                       "declared_suffix", status.alias("status"))


def inventory_summary(df: DataFrame, source_col: str, size_col: str, name_col: str, k: int = 3) -> DataFrame:
    """Per source: file count, size in MB (2 dp), first ``k`` names.

    The first names are picked with a per-group limit (planned with a partial
    ``WindowGroupLimit``) before being gathered, so at most ``k`` names per
    source are ever collected.
    """
    from panelkit.operators.joins import top_k

    totals = df.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("files"),
        rnd(F.sum(size_col) / 1024.0 / 1024.0, 2).alias("size_mb"))
    first = top_k(df.select(source_col, name_col), [source_col], [F.asc(name_col)], k, "__rk")
    examples = first.groupBy(source_col).agg(
        F.array_join(F.array_sort(F.collect_list(name_col)), ", ").alias("examples"))
    return totals.join(examples, source_col, "left")


def url_suffix(url) -> Column:
    """Suffix of the last path segment (``pathlib`` rules: needs a stem)."""
    path = F.coalesce(F.try_parse_url(_col(url), F.lit("PATH")), F.lit(""))
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def decoded_head(content, size: int = CSV_SNIFF_BYTES) -> Column:
    """The first ``size`` bytes of a binary column as text: UTF-8 where they are valid UTF-8, else Latin-1."""
    head = F.substring(_col(content), 1, size)
    return F.when(F.is_valid_utf8(head.cast("string")), head.cast("string")).otherwise(F.decode(head, "ISO-8859-1"))


def looks_like_semicolon_csv(text) -> Column:
    """Whether a decoded text's first line is a semicolon header that names one of :data:`CSV_HEADER_WORDS`."""
    first = F.regexp_extract(_col(text), r"^([^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]*)", 1)
    named = F.lit(False)
    for word in CSV_HEADER_WORDS:
        named = named | first.contains(word)
    return F.coalesce(first.contains(";") & named, F.lit(False))


def sniff_payload(url, content_type, content, strict: bool = False) -> Column:
    """Extension first, then content type, then magic bytes:
    ``{`` -> .json, ``PK`` -> .xlsx, ``;`` in the first 2 KiB -> .csv, else .bin.
    (The 2 KiB window is measured in characters of the decoded text.)

    ``strict`` is the downloader's variant: ``content`` is binary, only the
    extension (as it is written) and the content type tell .xlsx and .json,
    and a payload without either is .csv only with a semicolon header
    (:func:`looks_like_semicolon_csv`).
    """
    suffix = url_suffix(url)
    ct = F.coalesce(_col(content_type), F.lit("application/octet-stream"))
    if strict:
        return (F.when(suffix != "", suffix)
                 .when(ct.contains("spreadsheet") | ct.contains("excel"), F.lit(".xlsx"))
                 .when(ct.contains("json"), F.lit(".json"))
                 .when(ct.contains("csv") | looks_like_semicolon_csv(decoded_head(content)), F.lit(".csv"))
                 .otherwise(F.lit(".bin")))
    ct = F.lower(ct)
    body = F.coalesce(_col(content).cast("string"), F.lit(""))
    stripped = F.regexp_replace(body, "^" + ASCII_WS + "+", "")
    return (F.when(suffix != "", suffix)
             .when(ct.contains("json") | stripped.startswith("{"), F.lit(".json"))
             .when(ct.contains("spreadsheet") | ct.contains("excel") | body.startswith("PK"), F.lit(".xlsx"))
             .when(ct.contains("csv") | F.substring(body, 1, CSV_SNIFF_BYTES).contains(";"), F.lit(".csv"))
             .otherwise(F.lit(".bin")))


def reject_reason(content, suffix, min_bytes: int = 100) -> Column:
    """Why a payload must be quarantined, NULL when it is fine:
    too small, HTML instead of data, or an .xlsx without the ``PK`` header."""
    body = F.coalesce(_col(content).cast("string"), F.lit(""))
    head = F.lower(F.substring(F.regexp_replace(body, "^" + ASCII_WS + "+", ""), 1, 32))
    return (F.when(F.octet_length(body) < min_bytes, F.lit("too_small"))
             .when(head.startswith("<!doctype html") | head.startswith("<html"), F.lit("html"))
             .when((_col(suffix) == ".xlsx") & ~body.startswith("PK"), F.lit("not_xlsx")))


def explode_parallel_arrays(df: DataFrame, struct_col: str, time_field: str, value_fields: list[str],
                            keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``time_field``; every other array is read
    at the same position, NULL when it is shorter or missing."""
    keep = keep or []
    s = F.col(struct_col)
    exploded = df.select(*keep, s.alias("__s"), F.posexplode(s[time_field]).alias("__pos", time_field))
    return exploded.select(
        *keep, time_field, *[F.try_element_at(F.col("__s")[v], F.col("__pos") + 1).alias(v) for v in value_fields])


def read_daily_json(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """S1 scan: column-array JSON documents with a fixed schema (missing
    variables are NULL arrays), exploded to one row per day. A document that
    does not parse fails the read."""
    daily = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))] +
                         [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables])
    schema = T.StructType([T.StructField("daily", daily)])
    df = read_with_file_name(spark, "json", path, schema, multiLine="true", mode="FAILFAST")
    df = df.withColumn("location_code", location_code("source_file"))
    return explode_parallel_arrays(df, "daily", "time", variables, keep=["source_file", "location_code"])


def pending(plan: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Planned keys that have not landed yet."""
    return plan.join(landed.select(*keys).distinct(), keys, "left_anti")


def query_string(params: list[tuple[str, Column]]) -> Column:
    """``k=v`` pairs joined by ``&``; a NULL value drops its pair."""
    parts = [F.concat(F.lit(k + "="), F.url_encode(v.cast("string"))) for k, v in params]
    return F.concat_ws("&", *parts)


def request_url(base: str, params: list[tuple[str, Column]]) -> Column:
    qs = query_string(params)
    return F.when(qs == "", F.lit(base)).otherwise(F.concat(F.lit(base + "?"), qs))


def coerce_numeric(df: DataFrame, exempt: list[str] | None = None,
                   boolean_cols: list[str] | None = None) -> DataFrame:
    """Per column, ``try_cast`` to double when at least one value parses
    (unparsable -> NULL); a column where nothing parses keeps its text.
    Boolean columns accept ``true/1/yes``.

    Which columns parse is decided from one aggregate returning one count per
    column (a single small row to the driver).
    """
    exempt = set(exempt or [])
    booleans = set(boolean_cols or [])
    cands = [c for c, t in df.dtypes if c not in exempt and c not in booleans and t == "string"]
    parsed = {}
    if cands:
        # per column: values that parse, and values present at all (an
        # all-NULL column is converted too, as the reference's coercion does)
        row = df.agg(*[F.count(F.expr(f"try_cast(`{c}` AS DOUBLE)")).alias(c) for c in cands],
                     *[F.count(c).alias(f"__n_{c}") for c in cands]).first()
        parsed = {c: row[c] > 0 or row[f"__n_{c}"] == 0 for c in cands}
    exprs = {}
    for c in df.columns:
        if c in booleans:
            exprs[c] = F.lower(F.trim(F.col(c).cast("string"))).isin("true", "1", "yes")
        elif parsed.get(c):
            exprs[c] = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return df.withColumns(exprs)
