"""Metamorphic and skew properties."""

import random

from pyspark.sql import functions as F

from panelkit.operators import joins as J
from panelkit.operators import profile as PR
from panelkit.operators import rollups as R
from panelkit.plans import panel as P

SF = "/root/testdata/sf0.001"


def skewed_rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 50)  # key 0 holds a third of the rows
        rows.append((key, i, rnd.random() < 0.2, float(rnd.randint(0, 100))))
    return rows


def test_hot_key_operators_match_brute_force(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k long, t long, m boolean, v double").repartition(7)
    # latest per key
    latest = {r.k: r.t for r in J.latest_per_key(df, ["k"], ["t"]).collect()}
    want = {}
    for k, t, _, _ in rows:
        want[k] = max(want.get(k, -1), t)
    assert latest == want
    # top-3 per key
    top = {}
    for r in J.top_k(df, ["k"], [F.desc("v"), F.asc("t")], 3).collect():
        top.setdefault(r.k, []).append(r.t)
    for k in want:
        exp = [t for _, t in sorted(((-v, t) for kk, t, _, v in rows if kk == k))[:3]]
        assert sorted(top[k]) == sorted(exp)
    # forward as-of match, two-level bucketed form
    got = {(r.k, r.t): r.nx for r in J.next_match(df, ["k"], "t", F.col("m"), "nx", hot_rows=0).collect()}
    for k, t, _, _ in rows[:300]:
        later = [tt for kk, tt, mm, _ in rows if kk == k and mm and tt > t]
        assert got[(k, t)] == (min(later) if later else None)
    # modes and rollups under the hot key
    sums = {r.k: r.v_total for r in R.monthly_rollup(df, ["k"], [], ["v"]).collect()}
    assert sums[0] == sum(v for k, _, _, v in rows if k == 0)
    mode = PR.column_modes(df.where("k = 0"), ["v"]).first()["mode"]
    vals = [v for k, _, _, v in rows if k == 0]
    best = max(vals.count(x) for x in set(vals))
    assert mode == min(x for x in set(vals) if vals.count(x) == best)


def test_panel_independent_of_input_partitioning(spark):
    d = P.daily(spark, SF)
    a = P.monthly(d)
    b = P.monthly(d.repartition(13, "order_key").sortWithinPartitions(F.rand(1)))
    assert sorted(a.collect()) == sorted(b.collect())


def test_child_rollup_sums_to_parent(spark):
    child = P.supplier_months(spark, SF)
    parent = P.supplier_rollup(spark, SF)
    c = child.agg(F.sum("ship_qty"), F.sum("ship_lines"), F.count(F.lit(1))).first()
    p = parent.agg(F.sum("ship_qty"), F.sum("ship_lines"), F.sum("supplier_count")).first()
    assert tuple(c) == tuple(p)


def test_panel_one_row_per_key_and_keeps_driver_rows(spark):
    panel = P.monthly_feature_panel(spark, SF)
    base = P.monthly(P.daily(spark, SF))
    assert panel.count() == base.count() == panel.select("entity", "year_month").distinct().count()
