import json
import os

import pytest
from pyspark.sql import functions as F

from panelkit import schemas
from panelkit.sources import files as S
from panelkit.sources import readers as RD
from panelkit.sources import sinks as SK


def test_file_inventory_and_summary(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "src_a"))
    for name, size in [("b.CSV", 10), ("a.xlsx", 20), ("c.json", 5), ("c.json.metadata.json", 3)]:
        with open(os.path.join(tmp_dir, "src_a", name), "wb") as fh:
            fh.write(b"x" * size)
    inv = S.file_inventory(spark, tmp_dir)
    rows = {r.file_name: (r.suffix, r.bytes) for r in inv.collect()}
    assert rows == {"b.CSV": (".csv", 10), "a.xlsx": (".xlsx", 20), "c.json": (".json", 5)}
    # content is never read: the scan's schema has no content column
    assert "content" not in inv._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:200]
    summ = S.inventory_summary(inv.withColumn("source", F.lit("src_a")), "source", "bytes", "file_name", 2).first()
    assert (summ.files, summ.size_mb, summ.examples) == (3, 0.0, "a.xlsx, b.CSV")


def test_semicolon_csv_with_latin1_fallback(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "utf8.csv"), "w", encoding="utf-8") as fh:
        fh.write("AÑO;MES;PROVINCIA\n2024;1;Málaga\n")
    with open(os.path.join(tmp_dir, "latin.csv"), "w", encoding="latin-1") as fh:
        fh.write("AÑO;MES;PROVINCIA\n2024;2;Cádiz\n")
    df = RD.read_csv_utf8_or_latin1(spark, tmp_dir)
    got = sorted((r["MES"], r["PROVINCIA"]) for r in df.collect())
    assert got == [("1", "Málaga"), ("2", "Cádiz")]
    assert dict(df.dtypes)["AÑO"] == "string"


def test_manifests(spark, tmp_dir):
    doc = {"source": "dataestur", "url": "https://x.es/a", "downloaded_at": "20240101T000000Z",
           "content_type": "text/csv", "bytes_written": 6093621, "local_path": "/d/a.csv"}
    with open(os.path.join(tmp_dir, "a.csv.metadata.json"), "w") as fh:
        json.dump(doc, fh, indent=2)
    with open(os.path.join(tmp_dir, "a.csv"), "w") as fh:
        fh.write("x\n")
    m = RD.read_manifests(spark, tmp_dir).collect()
    assert len(m) == 1 and m[0].bytes_written == 6093621 and m[0].name is None


def test_payload_sniff_and_reject(spark):
    rows = [("https://h/a.json", None, "{}"), ("https://h/dl", "application/json", "[1]"),
            ("https://h/dl", None, "  {\"a\": 1}"), ("https://h/dl", None, "PK\x03\x04"),
            ("https://h/dl", None, "AÑO;MES\n1;2"), ("https://h/dl", None, "plain"),
            ("https://h/dl", None, "<!DOCTYPE html><html>" + "x" * 200)]
    df = spark.createDataFrame(rows, "url string, ct string, body string")
    df = df.withColumn("suffix", S.sniff_payload("url", "ct", "body"))
    got = [(r.suffix, r.why) for r in df.select("suffix", S.reject_reason("body", "suffix").alias("why")).collect()]
    assert [g[0] for g in got] == [".json", ".json", ".json", ".xlsx", ".csv", ".bin", ".bin"]
    assert [g[1] for g in got] == ["too_small"] * 6 + ["html"]
    big_not_xlsx = spark.createDataFrame([("x" * 200, ".xlsx")], "b string, s string")
    assert big_not_xlsx.select(S.reject_reason("b", "s").alias("w")).first().w == "not_xlsx"


def test_request_url_omits_unset_params(spark):
    df = spark.createDataFrame([(2015, None)], "y int, m int")
    url = df.select(S.request_url("https://h/api", [("desde", F.col("y")), ("mes", F.col("m")),
                                                     ("q", F.lit("a b"))]).alias("u")).first().u
    assert url == "https://h/api?desde=2015&q=a+b"


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1", "x", "yes", "a"), ("2.5", "y", "0", "b"), ("bad", None, "TRUE", "c")],
                               "n string, t string, flag string, keep string")
    out = S.coerce_numeric(df, exempt=["keep"], boolean_cols=["flag"])
    types = dict(out.dtypes)
    assert (types["n"], types["t"], types["flag"], types["keep"]) == ("double", "string", "boolean", "string")
    assert [r.n for r in out.collect()] == [1.0, 2.5, None]
    assert [r.flag for r in out.collect()] == [True, False, True]


def test_sinks_partitions_and_catalog(spark, tmp_dir):
    df = spark.createDataFrame([("A", "2024-01", 2024, 1, 1.0), ("B", "2024-02", 2024, 2, 2.0)],
                               "province string, year_month string, year int, month int, v double")
    out = os.path.join(tmp_dir, "gold")
    SK.write_table(df, out, partition_by=["year", "month"])
    back = spark.read.parquet(out).where("year = 2024 AND month = 2")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:200]
    assert [r.province for r in back.collect()] == ["B"]
    csv_out = os.path.join(tmp_dir, "csv")
    SK.write_table(df, csv_out, fmt="csv")
    assert spark.read.option("header", "true").csv(csv_out).count() == 2
    ddl = "province string, year_month string, v double"
    loc = os.path.join(tmp_dir, "silver")
    SK.write_table(SK.conform(df.drop("year", "month"), ddl), loc)
    t = SK.register_table(spark, "t_silver_test", loc, ddl)
    assert spark.sql("SELECT count(*) AS n FROM t_silver_test").first().n == 2 and t.columns == ["province", "year_month", "v"]
    sql = SK.create_table_sql("gold_tourism_weather_monthly_features", "s3a://b/gold",
                              schemas.GOLD_MONTHLY_FEATURES)
    assert sql.count("`") == 2 * 32 and "USING PARQUET" in sql


def test_conform_rejects_unexpected(spark):
    import pytest
    df = spark.createDataFrame([("A", 1)], "province string, extra int")
    with pytest.raises(ValueError):
        SK.conform(df, "province string")


def test_catalog_schemas_gold_has_31_columns():
    assert len(schemas.struct(schemas.GOLD_MONTHLY_FEATURES).fields) == 31


def test_coerce_numeric_all_null_column_becomes_numeric(spark):
    df = spark.createDataFrame([("1", None), ("2", None)], "a string, b string")
    assert dict(S.coerce_numeric(df).dtypes) == {"a": "double", "b": "double"}


def _landed(tmp_dir, files):
    for name, body in files.items():
        with open(os.path.join(tmp_dir, name), "wb") as out:
            out.write(body)


@pytest.mark.parametrize("url, content_type, body, suffix", [
    ("https://x/a.XLS?y=1", "text/csv", b"PK", ".XLS"),
    ("https://x/a", "application/vnd.ms-excel", b"", ".xlsx"),
    ("https://x/a", "application/json", b"PK", ".json"),
    ("https://x/a", "text/csv", b"", ".csv"),
    ("https://x/a", None, "AÑO;MES\n1;2".encode(), ".csv"),
    ("https://x/a", None, "AÑO;N\n1;2".encode("latin-1"), ".csv"),
    ("https://x/a", None, b"MES;N\r\n1;2", ".csv"),
    ("https://x/a", None, b"YEAR;N\nMES;2", ".bin"),           # named in the second line only
    ("https://x/a", None, b"MES,N\n1;2", ".bin"),              # no semicolon in the header
    ("https://x/a", None, b"{\"a\": 1}", ".bin"),              # magic bytes do not count here
    ("https://x/a", None, b"PK\x03\x04", ".bin"),
    ("https://x/a", None, b"MES" + b" " * 2100 + b";", ".bin"),  # beyond the first 2048 bytes
    ("https://x/a", None, b"", ".bin"),
    ("https://x/a", None, None, ".bin"),
])
def test_strict_sniffing(spark, url, content_type, body, suffix):
    df = spark.createDataFrame([(url, content_type, bytearray(body) if body is not None else None)],
                               "u string, ct string, b binary")
    assert df.select(S.sniff_payload("u", "ct", "b", strict=True)).first()[0] == suffix


def test_headers_are_grouped_or_refused(spark, tmp_dir):
    _landed(tmp_dir, {"a.csv": "AÑO;MES\n1;é\n".encode(), "b.csv": "AÑO;MES\n2;é\n".encode("latin-1"),
                      "c.csv": "MES;AÑO\r\nx;3\r\n".encode(), "d.csv": b"a;b\n1;2\n", "e.txt": b"plain\n", "f.csv": b""})
    groups = RD.read_csv_by_header(spark, tmp_dir)
    got = {h: sorted((r["AÑO"], r["MES"], r["source_file"]) for r in df.collect()) for h, df in groups.items()}
    assert got == {"AÑO;MES": [("1", "é", "a.csv"), ("2", "é", "b.csv")], "MES;AÑO": [("3", "x", "c.csv")]}
    with pytest.raises(ValueError, match="different headers"):
        RD.read_csv_utf8_or_latin1(spark, tmp_dir)


def test_manifests_are_reconciled_with_files(spark):
    files = spark.createDataFrame([("a", 10, ".csv"), ("b", 20, ".csv"), ("c", 30, ".csv"), ("d", 40, ".csv"),
                                   (None, 1, ".csv")], "name string, bytes long, suffix string")
    told = spark.createDataFrame([("a", 10, ".CSV"), ("b", 21, ".csv"), ("c", 30, ".json"), ("e", 5, ".csv"),
                                  ("a", 11, ".csv")], "name string, bytes_written long, detected_format string")
    got = sorted((r.name or "", r.bytes or 0, r.declared_bytes or 0, r.status)
                 for r in S.reconcile_manifests(files, told, "name").collect())
    assert got == [("", 1, 0, "missing_manifest"), ("a", 10, 10, "ok"), ("a", 10, 11, "size_differs"),
                   ("b", 20, 21, "size_differs"), ("c", 30, 30, "suffix_differs"), ("d", 40, 0, "missing_manifest"),
                   ("e", 0, 5, "missing_file")]


def test_csv_keeps_empty_and_missing_text(spark, tmp_dir):
    from panelkit.sources import sinks

    rows = [("1", "", None), ("2", None, ""), ("3", 'q"x,\n"', " a "), ("4", '""', "\\N"), ("", ",", "#")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    sinks.write_table(df, f"{tmp_dir}/csv", fmt="csv")
    back = RD.read_csv_strings(spark, f"{tmp_dir}/csv").drop("source_file")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_partitioned_sink_bounds_files_and_prunes(spark, tmp_dir):
    from panelkit.sources import sinks

    df = spark.range(20_000).selectExpr("id", "CAST(IF(id % 3 = 0, 0, id % 7) AS INT) AS part").repartition(13)
    sinks.write_table(df, f"{tmp_dir}/t", partition_by=["part"], rows_per_file=5_000)
    counts = {r.part: (r.files, r.rows) for r in spark.read.parquet(f"{tmp_dir}/t").groupBy("part").agg(
        F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("rows")).collect()}
    assert set(counts) == set(range(7)) and sum(n for _, n in counts.values()) == 20_000
    assert all(files <= -(-n // 5_000) for files, n in counts.values())      # not one file per task and value
    plan = spark.read.parquet(f"{tmp_dir}/t").where("part = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_column_profile_counts_without_expanding(spark):
    import math

    from panelkit.operators.profile import column_profile

    rows = [(1, 0.0, "a" * 70, [1], b"x"), (2, -0.0, "a" * 70, [1], b"x"), (2, math.nan, "b" * 70, None, None),
            (None, 5.0, "", [2], b""), (3, math.nan, None, [], b"y")]
    df = spark.createDataFrame(rows, "i int, d double, s string, l array<int>, b binary")
    prof = column_profile(df)
    assert "Expand" not in prof._jdf.queryExecution().executedPlan().toString()
    got = {r.column: (r.non_null, r.nulls, r.unique) for r in prof.collect()}
    assert got == {"i": (4, 1, 3), "d": (5, 0, 3), "s": (4, 1, 3), "l": (4, 1, 3), "b": (4, 1, 3)}
    empty = column_profile(df.limit(0)).orderBy("pos").collect()
    assert [r.column for r in empty] == df.columns and all((r.non_null, r.nulls, r.unique) == (0, 0, 0) for r in empty)
