import math

import pytest
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import models as MO
from panelkit.operators import profile as PR
from panelkit.operators import timeseries as TS


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None), (1.0, None), (1.0, None), (2.0, None)],
                               "x double, y double")
    got = {r.column: r.mode for r in PR.column_modes(df, ["x", "y"]).collect()}
    assert got == {"x": 1.0, "y": None}


def test_describe_median_and_stds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    d = PR.describe_columns(df, ["x"], digits=None).first()
    assert d.p50 == 2.5 and d.p25 == 1.75 and d.p75 == 3.25
    assert round(d.std, 3) == 1.291
    sc = FE.fit_scaler(df, ["x"]).first()
    assert round(sc["x__std"], 3) == 1.118


def test_quantile_bucket_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    got = [r.seg for r in FE.quantile_bucket(df, "x", ["low", "medium", "high", "very_high"], "seg")
           .orderBy("x").collect()]
    assert got == ["low", "medium", "high", "very_high"]  # edges 1.75, 2.5, 3.25; lowest included


def test_split_111_months_is_88_23(spark):
    months = [f"{2015 + (9 + i) // 12}-{(9 + i) % 12 + 1:02d}" for i in range(111)]
    df = spark.createDataFrame([(m, p) for m in months for p in ("A", "B")], "ym string, p string")
    tr, te = FE.train_test(df, "ym", 0.8)
    trm = {r.ym for r in tr.select("ym").distinct().collect()}
    tem = {r.ym for r in te.select("ym").distinct().collect()}
    assert (len(trm), len(tem)) == (88, 23)
    assert not trm & tem and max(trm) < min(tem)
    assert tr.count() + te.count() == df.count()


def test_train_only_statistics(spark):
    df = spark.createDataFrame([("2024-01", 1.0, 5.0), ("2024-02", 3.0, 5.0), ("2024-03", None, 5.0),
                                ("2024-04", 100.0, 5.0), ("2024-05", None, 5.0)], "ym string, x double, z double")
    tr, te = FE.train_test(df, "ym", 0.6)
    med = FE.fit_medians(tr, ["x"])
    assert med.first().x == 2.0  # (1 + 3) / 2, test values never seen
    filled = {r.ym: r.x for r in FE.apply_medians(df, med).collect()}
    assert filled["2024-03"] == 2.0 and filled["2024-05"] == 2.0
    scaled = FE.apply_scaler(tr, FE.fit_scaler(tr, ["z"]), ["z"]).collect()
    assert all(r.z == 0.0 for r in scaled)  # zero variance divides by 1


def test_one_hot_unseen_is_all_zero(spark):
    df = spark.createDataFrame([("2024-01", "b"), ("2024-02", "a"), ("2024-03", "c")], "ym string, cat string")
    tr = df.where("ym < '2024-03'")
    out = {r.cat: (r.cat_slot, r.cat_width) for r in FE.one_hot_slot(df, tr, "cat").collect()}
    assert out == {"a": (0, 2), "b": (1, 2), "c": (None, 2)}


def test_prepare_matrix_width_and_names(spark):
    rows = [(f"2024-{m:02d}", p, float(m), None if m == 3 else float(m * 2), r)
            for m in range(1, 11) for p, r in (("A", "N"), ("B", "S"), ("C", "N"))]
    df = spark.createDataFrame(rows, "ym string, prov string, x double, y double, region string")
    tr, te = FE.train_test(df, "ym", 0.8)
    trx, tex, names = FE.prepare_matrix(tr, te, ["x", "y"], ["prov", "region"])
    width = len(trx.first().features)
    assert width == len(names) == 2 + 3 + 2
    assert names[:2] == ["x", "y"] and names[2:5] == ["prov_A", "prov_B", "prov_C"]
    assert tex.count() == 6


def test_iqr_outliers_strict(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = PR.iqr_outliers(df, ["x"]).first()
    assert (r.lower_bound, r.upper_bound, r.outliers) == (-1.0, 7.0, 1)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 41)], "x double")
    h = {r.bin: r["count"] for r in PR.histogram(df, "x", 40).collect()}
    assert len(h) == 40 and h[39] == 2 and sum(h.values()) == 41


def test_boxplot_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    b = PR.boxplot_stats(df, "x").first()
    assert (b.q1, b.median, b.q3, b.whisker_low, b.whisker_high, b.fliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    got = {(r.column_a, r.column_b): r.corr for r in PR.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] == 1.0 and got[("b", "a")] == 1.0


def test_duplicate_count_and_missing_summary(spark):
    df = spark.createDataFrame([("A", "1", None), ("A", "1", 2.0), ("B", None, None), ("B", None, 1.0)],
                               "p string, ym string, t double")
    assert PR.duplicate_count(df, ["p", "ym"]).first().duplicates == 2
    ms = [(r.column, r.missing) for r in PR.missing_summary(df).collect()]
    assert ms == [("t", 2), ("ym", 2)]


def test_lags_rolling_yoy_use_calendar_months(spark):
    rows = [("A", i, float(i)) for i in list(range(0, 14)) if i != 5]
    df = spark.createDataFrame(rows, "p string, idx long, x double")
    lag = {r.idx: r.x_lag1 for r in TS.add_lags(df, ["p"], "idx", ["x"], [1]).collect()}
    assert lag[6] is None and lag[7] == 6.0  # the gap at 5 gives NULL, not month 4
    roll = {r.idx: r.x_mean3 for r in TS.rolling_mean(df, ["p"], "idx", ["x"], 3).collect()}
    assert roll[0] is None and roll[3] == 1.0 and roll[7] == 5.0  # mean of 4 and 6
    yoy = {r.idx: r.x_yoy for r in TS.year_over_year(df, ["p"], "idx", ["x"]).collect()}
    assert yoy[12] is None and yoy[13] == 12.0  # base 0 -> NULL; (13-1)/1


def test_bridge_days(spark):
    cal = spark.createDataFrame([("2024-10-01",), ("2024-10-03",), ("2024-10-04",)], "date string")
    got = {(str(r.bridge_day), str(r.because_of)) for r in TS.bridge_days(cal).collect()}
    assert got == {("2024-09-30", "2024-10-01")}  # Friday 10-04 is itself a holiday


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    m = MO.regression_metrics(df, "y", "p").first()
    assert m.mae == round(1 / 3, 6) and m.rmse == round(math.sqrt(1 / 3), 6) and m.r2 == 0.5


def test_expanding_folds_no_leak(spark):
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    df = spark.createDataFrame([(m, 1) for m in months], "ym string, v long")
    t = FE.expanding_folds(df, "ym", 3).collect()
    for f in (1, 2, 3):
        tr = {r.ym for r in t if r.fold == f and r.role == "train"}
        te = {r.ym for r in t if r.fold == f and r.role == "test"}
        assert tr and te and max(tr) < min(te)
    assert {r.ym for r in t if r.fold == 3 and r.role == "test"} == {"2024-10", "2024-11", "2024-12"}


def test_fit_regressors_and_preview(spark):
    from panelkit.operators.features import preview

    rows = [(f"2024-{m:02d}", p, float(m), float(m * 3 + (1 if p == "A" else 0)), float(m * 30))
            for m in range(1, 13) for p in ("A", "B")]
    df = spark.createDataFrame(rows, "ym string, prov string, x double, z double, y double")
    tr, te = FE.train_test(df, "ym", 0.75)
    trx, tex, names = FE.prepare_matrix(tr, te, ["x", "z"], ["prov"])
    models = MO.fit_regressors(trx, "features", "y")
    assert set(models) == {"ridge", "random_forest", "gbt"}
    scored = models["ridge"].transform(tex)
    m = MO.regression_metrics(scored, "y", "prediction").first()
    assert m.n == 6 and m.r2 > 0.5
    pv = preview(trx, names, 3, order=["ym", "prov"], keep=["ym"]).collect()
    assert len(pv) == 3 and list(pv[0].asDict()) == ["ym", "x", "z", "prov_A", "prov_B"]


def test_numeric_columns_excludes_booleans(spark):
    df = spark.createDataFrame([(1, 2.0, True, "a")], "i int, d double, b boolean, s string")
    assert PR.numeric_columns(df) == ["i", "d"]


def test_exact_quantiles_equal_percentile(spark):
    import random

    from panelkit.operators.quantiles import exact_quantiles

    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 40)) if rnd.random() > 0.1 else None)
            for g in ("a", "b", "c") for _ in range(rnd.randint(2, 300))] + [("solo", 3.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    mine = {(r.g, r.p): r.q for r in exact_quantiles(df, "g", "v", ps, cuts=5000).collect()}
    ref = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).collect()
    for r in ref:
        for i, p in enumerate(ps):
            assert mine[(r.g, p)] == r.q[i], (r.g, p)


def test_exact_quantiles_of_every_magnitude(spark):
    import struct

    from panelkit.operators.quantiles import exact_quantiles, magnitude

    near = lambda v, k: struct.unpack("<d", struct.pack("<q", struct.unpack("<q", struct.pack("<d", v))[0] + k))[0]
    values = {0.0, 5e-324, 1.7976931348623157e308, 1e-310, *(near(0.1, k) for k in range(-40, 40, 3))}
    for e in range(-1073, 1023):   # powers of two and their neighbours
        values |= {near(2.0 ** e, k) for k in (-1, 0, 1)}
    rows = sorted(values | {-v for v in values})
    df = spark.createDataFrame([(v,) for v in rows + [float("inf")]], "v double").orderBy("v")
    steps = [r.m for r in df.select(magnitude(F.col("v")).alias("m")).collect()]
    assert steps == sorted(steps)
    long = spark.createDataFrame([("g", v) for v in rows] + [("g", None), ("g", float("nan")), ("i", float("inf"))],
                                 "g string, v double")
    ps = [k / 997 for k in range(0, 998, 7)] + [1.0]
    want = []
    for p in ps:
        pos = (len(rows) - 1) * p
        lo, hi = rows[int(pos // 1)], rows[int(-(-pos // 1))]
        want.append(lo if lo == hi else (-(-pos // 1) - pos) * lo + (pos - pos // 1) * hi)
    got = {(r.g, r.p): r.q for r in exact_quantiles(long, "g", "v", ps).collect()}
    assert [got["g", p] for p in ps] == want and got["i", 1.0] == float("inf")


def test_quantile_plans_run_nothing_and_stay_small(spark):
    from panelkit.operators.quantiles import exact_quantiles

    long = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    exact_quantiles(long, "g", "v", [0.5])
    assert len(jobs.getJobIdsForGroup()) == before
