"""Inputs that once gave wrong, capped or lost results."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd
from panelkit.operators import profile as PR
from panelkit.operators.quantiles import exact_quantiles
from panelkit.sources import files as S
from panelkit.sources import readers as R

NAN = float("nan")


def test_rnd_has_no_cap_and_nan_is_missing(spark):
    df = spark.createDataFrame([(1e15,), (-1e300,), (NAN,), (float("inf"),), (1.00005,), (None,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 4)).collect()]
    assert got == [1e15, -1e300, None, float("inf"), 1.0001, None]


def test_nan_is_missing_in_profiles(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (NAN, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, k double")
    d = PR.describe_columns(df, ["x"]).first()
    assert (d["count"], d["mean"], d["p50"], d["max"]) == (4, 2.5, 2.5, 4.0)
    assert sum(r["count"] for r in PR.histogram(df, "x", 3).collect()) == 4
    assert PR.boxplot_stats(df, "x").first()["median"] == 2.5
    assert {r["column"]: r["missing"] for r in PR.missing_summary(df).collect()} == {"x": 1}


def test_correlation_with_a_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.0)], "x double, k double, y double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in PR.correlation_matrix(df, ["x", "k", "y"]).collect()}
    assert got["x", "k"] is None and got["k", "k"] is None and math.isclose(got["x", "y"], 1.0)


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("cuts", [1 << 11, 1 << 22])
def test_exact_quantiles_do_not_depend_on_exchange_reuse(spark, reuse, cuts):
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    long = line.select(F.lit("p").alias("g"), F.col("l_extendedprice").cast("double").alias("v"))
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = long.select(F.percentile("v", F.array(*[F.lit(p) for p in ps]))).first()[0]
    old = spark.conf.get("spark.sql.exchange.reuse")
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        got = {r["p"]: r["q"] for r in exact_quantiles(long, "g", "v", ps, cuts).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert [got[p] for p in ps] == list(want)


def test_latin1_fallback_is_by_full_path(spark, tmp_dir):
    for name, body in (("a", "c;d\n1;é\n".encode()), ("b", "c;d\n2;é\n".encode("latin-1"))):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/x.csv", "wb") as out:
            out.write(body)
    rows = R.read_csv_utf8_or_latin1(spark, f"{tmp_dir}/*").collect()
    assert sorted((r["c"], r["d"]) for r in rows) == [("1", "é"), ("2", "é")]


def test_csv_with_line_breaks_and_other_headers(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as out:
        out.write('a,b\n1,"x\ny"\n')
    assert [(r["a"], r["b"]) for r in R.read_csv_strings(spark, tmp_dir).collect()] == [("1", "x\ny")]
    with open(f"{tmp_dir}/b.csv", "w") as out:
        out.write("b,a\n10,20\n")
    with pytest.raises(Exception, match="(?i)header"):
        R.read_csv_strings(spark, tmp_dir).collect()


def test_truncated_json_fails(spark, tmp_dir):
    with open(f"{tmp_dir}/madrid_20150101_20151231_x.json", "w") as out:
        out.write('{"daily": {"time": ["2015-01-01"], "t": [1.0')
    with pytest.raises(Exception):
        S.read_daily_json(spark, tmp_dir, ["t"]).collect()


def test_latest_weather_keeps_every_date_range(spark, tmp_dir):
    from panelkit.plans.gold import weather_daily

    for name, day in (("madrid_20151001_20191231_1", "2015-10-01"), ("madrid_20200101_20241231_1", "2020-01-01"),
                      ("madrid_20200101_20241231_2", "2020-01-02")):
        with open(f"{tmp_dir}/{name}.json", "w") as out:
            out.write('{"daily": {"time": ["%s"]}}' % day)
    assert sorted(r["time"] for r in weather_daily(spark, tmp_dir).collect()) == ["2015-10-01", "2020-01-02"]
