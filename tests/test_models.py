"""Expanding folds, prepared matrices and tree models (D11-D13, M4-M6) on literal fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import evaluation as EV
from panelkit.operators import features as FE
from panelkit.operators import models as MO

DESIGN = EV.Design(["a", "b", "flat", "mostly"], "y", "month", ("b", "mostly"))


def rows_of(months=9, per_month=7, seed=3):
    rng = random.Random(seed)
    rows = []
    for m in range(months):
        for k in range(per_month):
            a, b = rng.gauss(50, 9), rng.gauss(0, 2)
            y = 3 * a - 5 * b + rng.gauss(0, 1)
            rows.append((f"2020-{m + 1:02d}", k, a, None if rng.random() < 0.2 else b, 1.0,
                         None if m < 4 or k else 2.5 * k + m, None if rng.random() < 0.05 else y))
    rows.append((None, 99, 1.0, 1.0, 1.0, 1.0, 1.0))
    return rows


SCHEMA = "month string, k int, a double, b double, flat double, mostly double, y double"


def brute(rows, k, alpha):
    """Fold -> (means, weights, n_train, n_test, mae, rmse, r2), each fold from its own rows."""
    rows = [r for r in rows if r[0] is not None and r[6] is not None]
    months = sorted({r[0] for r in rows})
    size = len(months) // (k + 1)
    out = {}
    for fold in range(1, k + 1 if size else 1):
        train = [r for r in rows if r[0] in months[:fold * size]]
        last = len(months) if fold == k else (fold + 1) * size
        test = [r for r in rows if r[0] in months[fold * size:last]]
        x = np.array([[np.nan if v is None else v for v in r[2:6]] for r in train], float)
        y = np.array([r[6] for r in train])
        means = np.array([0.0 if np.isnan(c).all() else np.nanmean(c) for c in x.T])
        x = np.where(np.isnan(x), means, x)
        sd = x.std(axis=0)
        sd[sd == 0] = 1
        z = (x - means) / sd
        w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (y - y.mean()))
        t = np.array([[np.nan if v is None else v for v in r[2:6]] for r in test], float)
        p = y.mean() + ((np.where(np.isnan(t), means, t) - means) / sd) @ w
        e = np.array([r[6] for r in test]) - p
        ty = np.array([r[6] for r in test])
        out[fold] = (means, w, len(train), len(test), abs(e).mean(), np.sqrt((e * e).mean()),
                     1 - (e * e).sum() / ((ty - ty.mean()) ** 2).sum())
    return out


@pytest.mark.parametrize("k", [1, 3])
def test_expanding_ridge_equals_refitting_every_fold(spark, k):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    models = EV.expanding_ridge(df, DESIGN, k, 0.7).cache()
    want = brute(rows, k, 0.7)
    got = {}
    for r in EV.coefficients(models, DESIGN).collect():
        got.setdefault(r.fold, {})[r.feature] = r
    scores = {r.fold: r for r in EV.fold_scores(EV.predict(df, DESIGN, models), "y").collect()}
    assert set(got) == set(scores) == set(want)
    for fold, (means, w, n_train, n_test, mae, rmse, r2) in want.items():
        assert np.allclose([got[fold][c]["mean"] for c in DESIGN.features], means)
        assert np.allclose([got[fold][c]["weight"] for c in DESIGN.features], w)
        s = scores[fold]
        assert (s.n_train, s.n_test) == (n_train, n_test)
        assert np.allclose([s.mae, s.rmse, s.r2], [mae, rmse, r2], atol=2e-6)


def test_fold_cases_without_an_answer(spark):
    few = spark.createDataFrame(rows_of(months=2), SCHEMA)
    assert EV.expanding_ridge(few, DESIGN, 4).count() == 0           # fewer months than folds
    assert EV.expanding_ridge(few.limit(0), DESIGN, 2).count() == 0
    strict = EV.Design(["a", "b"], "y", "month")
    with pytest.raises(Exception, match="NULL in feature b"):
        EV.expanding_ridge(spark.createDataFrame(rows_of(), SCHEMA), strict, 2).collect()


def test_one_pass_feeds_all_folds(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    plan = EV.expanding_ridge(df, DESIGN, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def matrix_rows(n=160, seed=1):
    rng = random.Random(seed)
    return [(k, rng.choice("uvw") if rng.random() < 0.9 else None, rng.choice(["p", "q"]),
             None if rng.random() < 0.1 else rng.gauss(5, 2), rng.randint(0, 40), rng.randint(1, 90)) for k in range(n)]


MATRIX = "id int, c1 string, c2 string, n1 double, n2 int, y int"


def test_preparation_survives_saving(spark, tmp_dir):
    rows = matrix_rows()
    train = spark.createDataFrame(rows[:120], MATRIX)
    test = spark.createDataFrame(rows[120:] + [(999, "new", None, None, 3, 1)], MATRIX)
    made = FE.Preparation.fit(train, ["n1", "n2"], ["c1", "c2"])
    made.save(f"{tmp_dir}/prep")
    back = FE.Preparation.load(spark, f"{tmp_dir}/prep")
    assert back.names == made.names == ["n1", "n2", "c1_u", "c1_unknown", "c1_v", "c1_w", "c2_p", "c2_q"]
    rows_of = lambda p: {(r.id, r.feature): r.value for r in FE.named_features(
        p.transform(test), p.names, ["id"]).collect()}
    got = rows_of(back)
    assert got == rows_of(made) and len(got) == 41 * 8
    n1 = np.array([r[3] for r in rows[:120] if r[3] is not None])
    filled = np.array([np.median(n1) if r[3] is None else r[3] for r in rows[:120]])
    assert np.isclose(got[999, "n1"], (np.median(n1) - filled.mean()) / filled.std())
    assert [got[999, c] for c in ("c1_u", "c1_v", "c1_w", "c1_unknown", "c2_p", "c2_q")] == [0, 0, 0, 0, 0, 0]


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_trees_do_not_depend_on_the_input_partitions(spark, kind):
    rows = matrix_rows()
    train, test = rows[:120], rows[120:]
    out = []
    for parts, order in ((2, 1), (7, -1)):
        a = spark.createDataFrame(train[::order], MATRIX).repartition(parts)
        b = spark.createDataFrame(test[::order], MATRIX).repartition(parts)
        got = MO.tree_predictions(a, b, kind, "y", ["id"], ["n1", "n2"], ["c1", "c2"], partitions=3)
        out.append({r.id: r.prediction for r in got.collect()})
        assert all(r.train_min <= r.prediction <= r.train_max for r in got.collect())
    assert set(out[0]) == {r[0] for r in test}
    assert all(abs(out[0][k] - out[1][k]) < 1e-9 for k in out[0])
    assert len(set(out[0].values())) > 5


def test_many_categories_are_ranked_without_one_sort(spark):
    cats = spark.range(30_000).select(F.format_string("c%06d", (F.col("id") * 7919) % 30_000).alias("c"))
    got = FE.category_index(cats, "c").orderBy("category").collect()
    assert [r.slot for r in got] == list(range(30_000))
    assert [r.category for r in got] == sorted(r.category for r in got)
    widest = FE.category_index(cats, "c").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert widest < 30_000
    assert FE.category_index(cats.limit(0), "c").count() == 0
