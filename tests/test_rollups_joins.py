import json
import os

import pytest
from pyspark.sql import functions as F

from panelkit.operators import joins as J
from panelkit.operators import rollups as R
from panelkit.operators import sets as U
from panelkit.sources import files as S

WEATHER_VARS = ["temperature_2m_mean", "precipitation_sum", "precipitation_hours"]


def test_weather_json_explode_and_monthly_rollup(spark, tmp_dir):
    doc = {"daily": {"time": ["2016-01-30", "2016-01-31", "2016-02-01"],
                     "temperature_2m_mean": [10.0, 12.0, None], "precipitation_sum": [1.5, 0.0],
                     "precipitation_hours": [2.0, 0.0, 3.0]}}
    path = os.path.join(tmp_dir, "MAD_20160130_20160201_20240101T000000Z.json")
    with open(path, "w") as fh:
        json.dump(doc, fh, indent=2)
    daily = S.read_daily_json(spark, tmp_dir, WEATHER_VARS)
    assert daily.count() == 3
    assert {r.location_code for r in daily.collect()} == {"MAD"}
    daily = daily.withColumn("year_month", F.substring("time", 1, 7))
    monthly = R.monthly_rollup(daily, ["location_code", "year_month"],
                               avg_cols=["temperature_2m_mean"],
                               sum_cols=["precipitation_sum", "precipitation_hours"])
    got = {r.year_month: r.asDict() for r in monthly.collect()}
    assert got["2016-01"]["days"] == 2
    assert got["2016-01"]["temperature_2m_mean_avg"] == 11.0
    assert got["2016-01"]["precipitation_sum_total"] == 1.5
    assert got["2016-01"]["precipitation_hours_total"] == 2.0
    assert got["2016-02"]["days"] == 1
    assert got["2016-02"]["temperature_2m_mean_avg"] is None
    assert got["2016-02"]["precipitation_sum_total"] is None
    assert got["2016-02"]["precipitation_hours_total"] == 3.0


def test_location_code_handles_2020_ranges(spark):
    df = spark.createDataFrame([("BCN_20200101_20241231_x.json",), ("MAD_20151001_20241231_y.json",)], "n string")
    assert [r.c for r in df.select(S.location_code("n").alias("c")).collect()] == ["BCN", "MAD"]


def test_file_fields(spark):
    df = spark.createDataFrame([("01.Enero-Definitivo-2015.xls",), ("01_Enero_Definitivo_2024.xlsx",),
                                ("resumen.xls",)], "n string")
    rows = S.with_file_fields(df, "n").collect()
    assert [(r.file_year, r.file_month) for r in rows] == [(2015, 1), (2024, 1), (None, None)]
    with pytest.raises(Exception):
        S.with_file_fields(df, "n", strict=True).collect()


def test_parent_rollup_sums_equal_children(spark):
    rows = [("A", "2024-01", "P1", 10, 1, 100), ("A", "2024-01", "P2", 0, 0, 0), ("B", "2024-01", "P3", 5, 2, 7)]
    df = spark.createDataFrame(rows, "prov string, ym string, ap string, p long, o long, c long")
    out = {r.prov: r for r in R.parent_rollup(df, ["prov", "ym"], ["p", "o", "c"], "n").collect()}
    assert (out["A"].p, out["A"].o, out["A"].c, out["A"].n) == (10, 1, 100, 2)  # zero child counts (L11)
    assert sum(r.p for r in out.values()) == sum(r[3] for r in rows)


def test_scoped_counts_excludes_other_scopes(spark):
    rows = [("2024-01", "ES", "national"), ("2024-01", "AN", "regional"), ("2024-01", "AN", "regional"),
            ("2024-01", "AN", "local")]
    df = spark.createDataFrame(rows, "ym string, rc string, scope string")
    got = {(r.ym, r.rc): r.n for r in R.scoped_counts(df, ["ym", "rc"], "scope", ["national", "regional"]).collect()}
    assert got == {("2024-01", "ES"): 1, ("2024-01", "AN"): 2}


def test_lookup_default_and_unmapped(spark):
    df = spark.createDataFrame([("A",), ("B",), ("Z",)], "k string")
    dim = spark.createDataFrame([("A", "x"), ("B", "y")], "k string, v string")
    out = {r.k: r.v for r in J.lookup(df, dim, "k", {"v": "k"}).collect()}
    assert out == {"A": "x", "B": "y", "Z": "Z"}
    assert [r.k for r in J.unmapped(df, dim, "k").collect()] == ["Z"]
    with pytest.raises(ValueError):
        J.unmapped(df, dim, "k", strict=True)


def test_resolve_alias_three_stages(spark):
    df = spark.createDataFrame([("GERONA",), (" Málaga ",), ("Atlantis ",), ("",), (None,)], "p string")
    aliases = spark.createDataFrame([("GERONA", "Girona")], "alias string, target string")
    canonical = spark.createDataFrame([("Girona",), ("Málaga",)], "name string")
    got = [r.p for r in J.resolve_alias(df, "p", aliases, canonical).collect()]
    assert got == ["Girona", "Málaga", "Atlantis", "", ""]


def test_drop_known_and_keep_keys(spark):
    regional = spark.createDataFrame([("2024-01-06", "Reyes", "AN"), ("2024-02-28", "Dia", "AN")],
                                     "d string, n string, r string")
    national = spark.createDataFrame([("2024-01-06", "Reyes")], "d string, n string")
    assert [r.n for r in J.drop_known(regional, national, ["d", "n"]).collect()] == ["Dia"]
    assert [r.n for r in J.keep_keys(regional, national, ["d", "n"]).collect()] == ["Reyes"]


def test_next_match_bucketed_equals_plain(spark):
    rows = [(u, t, t % 3 == 0) for u in range(3) for t in range(0, 50, 1)]
    df = spark.createDataFrame(rows, "u long, t long, m boolean")
    plain = J.next_match(df, ["u"], "t", F.col("m"), "nx")
    bucketed = J.next_match(df, ["u"], "t", F.col("m"), "nx", hot_rows=0)
    assert sorted(plain.collect()) == sorted(bucketed.select(*plain.columns).collect())
    got = {(r.u, r.t): r.nx for r in plain.collect()}
    assert got[(0, 0)] == 3 and got[(0, 3)] == 6 and got[(0, 49)] is None


def test_latest_per_key_and_top_k(spark):
    rows = [("a", 1, 10.0), ("a", 2, 30.0), ("a", 3, 20.0), ("b", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, ord long, v double")
    latest = {r.k: r.v for r in J.latest_per_key(df, ["k"], ["ord"]).collect()}
    assert latest == {"a": 20.0, "b": 5.0}
    top = J.top_k(df, ["k"], [F.desc("v"), F.asc("ord")], 2).collect()
    assert sorted((r.k, r.v) for r in top) == [("a", 20.0), ("a", 30.0), ("b", 5.0)]


def test_feature_panel_keeps_driver_rows(spark):
    driver = spark.createDataFrame([("A", "2024-01"), ("B", "2024-01")], "p string, ym string")
    side = spark.createDataFrame([("A", "2024-01", 3)], "p string, ym string, n long")
    hot = spark.createDataFrame([("B", "2024-01", 1.5)], "p string, ym string, h double")
    out = J.feature_panel(driver, [J.Side(side, ["p", "ym"], ["n"], {"n": 0}),
                                   J.Side(hot, ["p", "ym"], ["h"])])
    got = {r.p: (r.n, r.h) for r in out.collect()}
    assert got == {"A": (3, None), "B": (0, 1.5)}


def test_set_operators(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    assert sorted(r.k for r in U.key_union([a, b]).collect()) == [1, 2, 3]
    assert [r.k for r in U.key_except(a, b).collect()] == [1]
    assert [r.k for r in U.key_intersect(a, b).collect()] == [2]
    assert U.union_all([a, b]).count() == 5


def test_checkpoint_dir_is_read_from_session(spark):
    from panelkit.session import checkpoint_dir

    current = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark, "/should/not/be/used") == current


def test_bounded_broadcast_respects_the_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    p_small = J.bounded_broadcast(small, 100).join(spark.range(5), "id")._jdf.queryExecution().optimizedPlan().toString()
    p_big = J.bounded_broadcast(big, 100).join(spark.range(5), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in p_small.lower() and "broadcast" not in p_big.lower()


def test_column_profile_approx_distinct(spark):
    from panelkit.operators import profile as PR

    df = spark.createDataFrame([(i % 7, None if i % 3 else "x") for i in range(100)], "a int, b string")
    exact = {r.column: r.unique for r in PR.column_profile(df).collect()}
    approx = {r.column: r.unique for r in PR.column_profile(df, approx_distinct=True).collect()}
    assert exact == approx == {"a": 7, "b": 1}


def test_next_match_rejects_fractional_order(spark):
    df = spark.createDataFrame([(1, 0.5, True)], "u long, t double, m boolean")
    with pytest.raises(ValueError):
        J.next_match(df, ["u"], "t", F.col("m"), "nx")


def test_next_match_spreads_a_hot_key(spark):
    import random

    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randint(0, 900)]),
             rnd.random() < 0.02, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "u string, t long, m boolean, id int")
    plain = J.next_match(df, ["u"], "t", F.col("m"), "nx", hot_rows=None)
    spread = J.next_match(df, ["u"], "t", F.col("m"), "nx", hot_rows=500)
    assert spread.columns == plain.columns
    key = lambda r: r.id
    assert sorted(spread.collect(), key=key) == sorted(plain.collect(), key=key)
    text = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "__part" in text   # windows are per range partition and key
