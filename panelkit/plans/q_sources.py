"""Reader and sink queries (S3, S4, S13-S15, S17, P8, D10, D16): a driver table
is written to a folder of its own under ``spark.checkpoint.dir`` and read back
through the operator; the result must be the source table again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit import schemas
from panelkit.operators.profile import numeric_columns
from panelkit.plans.registry import register
from panelkit.plans.tables import table
from panelkit.session import shared_path
from panelkit.operators import sets
from panelkit.sources import files, readers, sinks

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
CUSTOMER_TEXT = ["c_custkey", "c_name", "c_mktsegment"]


def _folder(spark, label: str) -> str:
    """A fresh folder below the session's shared folder."""
    return shared_path(spark, label)


def _supplier(spark, sf):
    return sinks.conform(table(spark, sf, "supplier").select(*[c for c, _ in schemas.columns(SUPPLIER)]), SUPPLIER)


@register("csv_round_trip", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(replace(text, chr(13), ' '), chr(0), ' ') AS text,
           lang, source FROM documents
    UNION ALL SELECT 'no text', NULL, lang, '' FROM documents UNION ALL SELECT 'empty', '', NULL, source FROM documents""")
def csv_round_trip(spark, sf):
    """Texts with separators, quotes and line breaks, empty and missing ones, through a header CSV."""
    path = _folder(spark, "csv")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string"), F.translate("text", "\r\u0000", "  ").alias("text"), "lang", "source")
    blank, missing = F.lit(""), F.lit(None).cast("string")
    sinks.write_table(docs.unionByName(docs.select(F.lit("no text").alias("doc_id"), missing.alias("text"), "lang",
                                                   blank.alias("source")))
                      .unionByName(docs.select(F.lit("empty").alias("doc_id"), blank.alias("text"),
                                               missing.alias("lang"), "source")), path, fmt="csv")
    return readers.read_csv_strings(spark, path).drop("source_file")


@register("semicolon_csv_by_header", """
    SELECT 'AÑO;MES;TOTAL' AS header, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
           CAST(count(*) AS VARCHAR) AS total FROM orders GROUP BY ALL
    UNION ALL SELECT 'MES;AÑO;TOTAL', strftime(l_shipdate, '%Y'), strftime(l_shipdate, '%m'),
           CAST(count(*) AS VARCHAR) FROM lineitem GROUP BY ALL""")
def semicolon_csv_by_header(spark, sf):
    """A folder of UTF-8 and Latin-1 files with two headers, and others that are no semicolon tables."""
    path = _folder(spark, "headers")

    def months(name, day, first, second):
        parts = {"AÑO": F.date_format(day, "yyyy"), "MES": F.date_format(day, "MM")}
        counted = table(spark, sf, name).groupBy(parts["AÑO"].alias("AÑO"), parts["MES"].alias("MES")).agg(
            F.count("*").alias("TOTAL"))
        return counted.select(first, second, "TOTAL")

    for rows in (months("orders", "o_orderdate", "AÑO", "MES"), months("lineitem", "l_shipdate", "MES", "AÑO")):
        for encoding, part in (("UTF-8", 0), ("ISO-8859-1", 1)):
            (rows.where(F.col("MES").cast("int") % 2 == part).write.mode("append").option("header", "true")
             .option("sep", ";").option("encoding", encoding).csv(path))
    table(spark, sf, "region").select("r_name").write.mode("append").text(path)
    table(spark, sf, "region").select("r_regionkey", "r_name").write.mode("append").option("header", "true").option(
        "sep", ";").csv(path)
    out = [rows.select(F.lit(header).alias("header"), F.col("AÑO").alias("year"), F.col("MES").alias("month"),
                       F.col("TOTAL").alias("total"))
           for header, rows in readers.read_csv_by_header(spark, path).items()]
    return sets.union_all(out)


@register("strict_payload_sniff", """
    SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.json' WHEN 2 THEN '.csv' WHEN 3 THEN '.csv'
           WHEN 4 THEN '.bin' ELSE '.TXT' END AS suffix, count(*) AS payloads
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey""")
def strict_payload_sniff(spark, sf):
    """Payloads told by extension, content type, or a semicolon header in UTF-8 or Latin-1 bytes."""
    kind = F.col("c_nationkey") % 6
    body = lambda head: F.concat(F.lit(head), F.col("c_name"), F.lit(";"), F.col("c_custkey").cast("string"))
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(
        "n_nationkey",
        F.when(kind == 5, F.lit("https://x.org/a/b.TXT")).otherwise(F.lit("https://x.org/a/b")).alias("url"),
        F.when(kind == 0, F.lit("application/vnd.ms-excel")).when(kind == 1, F.lit("application/json")).alias("ct"),
        F.when(kind == 2, F.encode(body("AÑO;N\n"), "UTF-8")).when(kind == 3, F.encode(body("AÑO;N\n"), "ISO-8859-1"))
        .otherwise(F.encode(body("YEAR;N\nMES;"), "UTF-8")).alias("body"))
    return rows.groupBy("n_nationkey", files.sniff_payload("url", "ct", "body", strict=True).alias("suffix")).agg(
        F.count("*").alias("payloads"))


@register("manifest_reconciliation", """
    WITH sizes AS (SELECT s_nationkey AS k, CAST(sum(strlen(s_name) + 1) AS BIGINT) AS bytes FROM supplier GROUP BY s_nationkey)
    SELECT 'nation=' || k AS folder, bytes,
           CASE WHEN k % 5 <> 2 THEN bytes + CASE WHEN k % 5 = 1 THEN 7 ELSE 0 END END AS declared_bytes,
           CASE k % 5 WHEN 1 THEN 'size_differs' WHEN 2 THEN 'missing_manifest' WHEN 4 THEN 'suffix_differs' ELSE 'ok' END
           AS status FROM sizes
    UNION ALL SELECT 'nation=' || (k + 100), NULL, bytes, 'missing_file' FROM sizes WHERE k % 5 = 3""")
def manifest_reconciliation(spark, sf):
    """A folder of files listed without reading them, against JSON manifests with planted differences."""
    landed, notes = _folder(spark, "landed"), _folder(spark, "manifests")
    supplier = table(spark, sf, "supplier").select("s_name", F.col("s_nationkey").alias("nation"))
    supplier.repartition("nation").write.partitionBy("nation").text(landed)
    sizes = supplier.groupBy("nation").agg(F.sum(F.octet_length("s_name") + 1).alias("bytes"))
    kind = F.col("nation") % 5
    told = sizes.where(kind != 2).select(
        F.concat(F.lit("nation="), F.col("nation").cast("string")).alias("local_path"),
        (F.col("bytes") + F.when(kind == 1, F.lit(7)).otherwise(F.lit(0))).alias("bytes_written"),
        F.when(kind == 4, F.lit(".csv")).otherwise(F.lit(".txt")).alias("detected_format"))
    gone = sizes.where(kind == 3).select(F.concat(F.lit("nation="), (F.col("nation") + 100).cast("string")).alias("local_path"),
                                         F.col("bytes").alias("bytes_written"), F.lit(".txt").alias("detected_format"))
    told.unionByName(gone).write.option("maxRecordsPerFile", 1).json(notes)  # one document per file, as they land
    listed = files.file_inventory(spark, landed).withColumn("folder", F.regexp_extract("path", "([^/]+)/[^/]+$", 1))
    listed = listed.groupBy("folder", "suffix").agg(F.sum("bytes").alias("bytes"))
    manifests = readers.read_manifests(spark, notes, ".json").withColumn("folder", F.col("local_path"))
    return files.reconcile_manifests(listed, manifests, "folder").select("folder", "bytes", "declared_bytes", "status")


@register("csv_encoding_fallback", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' ñ' AS c_name, c_mktsegment FROM customer""")
def csv_encoding_fallback(spark, sf):
    """One folder with UTF-8 and Latin-1 semicolon files; every file is decoded by its own bytes."""
    path = _folder(spark, "encoded")
    rows = table(spark, sf, "customer").select(*CUSTOMER_TEXT).withColumn("c_name", F.concat("c_name", F.lit(" ñ")))
    for encoding, part in (("UTF-8", 0), ("ISO-8859-1", 1)):
        (rows.where(F.col("c_custkey") % 2 == part).write.mode("append").option("header", "true")
         .option("sep", ";").option("encoding", encoding).csv(path))
    return readers.read_csv_utf8_or_latin1(spark, path).drop("source_file")


@register("table_sink_round_trip", """
    SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey,
           CAST(s_acctbal AS DOUBLE) AS s_acctbal
    FROM supplier""")
def table_sink_round_trip(spark, sf):
    """A conformed table through the partitioned Parquet sink."""
    path = _folder(spark, "partitioned")
    sinks.write_table(_supplier(spark, sf), path, partition_by=["s_nationkey"])
    return spark.read.schema(schemas.struct(SUPPLIER)).parquet(path).select(
        *[c for c, _ in schemas.columns(SUPPLIER)])


@register("registered_table", """
    SELECT CAST(s_nationkey AS INTEGER) AS s_nationkey, count(*) AS suppliers, max(s_name) AS last_name
    FROM supplier GROUP BY s_nationkey""")
def registered_table(spark, sf):
    """Files registered as a catalog table with a declared schema, read by SQL."""
    path = _folder(spark, "registered")
    sinks.write_table(_supplier(spark, sf), path)
    name = f"panelkit_supplier_{uuid.uuid4().hex}"
    sinks.register_table(spark, name, path, SUPPLIER)
    out = spark.sql(f"SELECT s_nationkey, count(*) AS suppliers, max(s_name) AS last_name "
                    f"FROM {name} GROUP BY s_nationkey")
    spark.sql(f"DROP TABLE {name}")  # the entry only: the result reads the files it named
    return out


@register("versioned_table", """
    SELECT v.run_date, count(*) AS suppliers, max(s_name) AS last_name
    FROM supplier, (VALUES (DATE '2024-01-01', 0), (DATE '2024-02-01', 12)) v(run_date, least_nation)
    WHERE s_nationkey >= v.least_nation GROUP BY v.run_date""")
def versioned_table(spark, sf):
    """Two dataset versions; writing the second keeps the first, rewriting it replaces it."""
    path = _folder(spark, "versions")
    supplier = _supplier(spark, sf)
    sinks.write_versioned(supplier, path, "2024-01-01")
    sinks.write_versioned(supplier, path, "2024-02-01")
    sinks.write_versioned(supplier.where("s_nationkey >= 12"), path, "2024-02-01")
    return (spark.read.parquet(path).groupBy("run_date")
            .agg(F.count("*").alias("suppliers"), F.max("s_name").alias("last_name")))


@register("numeric_column_totals", """
    SELECT * FROM (
      SELECT 'c_custkey' AS "column", CAST(sum(c_custkey) AS DECIMAL(38, 2)) AS total FROM customer
      UNION ALL SELECT 'c_nationkey', CAST(sum(c_nationkey) AS DECIMAL(38, 2)) FROM customer
      UNION ALL SELECT 'c_acctbal', CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) FROM customer)""")
def numeric_column_totals(spark, sf):
    """The numeric columns, found from the schema, with their totals."""
    customer = table(spark, sf, "customer")
    cols = numeric_columns(customer)
    wide = customer.agg(*[F.sum(F.col(c).cast("decimal(18,2)")).cast("decimal(38,2)").alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "total")
