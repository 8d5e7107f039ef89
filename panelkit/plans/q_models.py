"""Models on the panel's modelling frame: expanding folds, ridge, forests, boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd
from panelkit.operators import evaluation as EV
from panelkit.operators import features as FE
from panelkit.operators import models as MO
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import with_blocks
from panelkit.plans.q_features import CATEGORICAL_FEATURES, NUMERIC_FEATURES, model_frame, split_frame
from panelkit.plans.registry import register
from panelkit.session import shared_path

FOLDS, ALPHA = 6, 1.0
QUARTERS = ["is_q2", "is_q3", "is_q4"]
DESIGN = EV.Design(["days", "price_avg", "price_n_avg", "national_count", "regional_count", "ship_lines",
                    "supplier_count", "month", "is_high_season", *QUARTERS], P.TARGET, "year_month", ("price_n_avg",))


def fold_frame(spark, sf):
    """The modelling frame with one 0/1 column per quarter but the first."""
    return model_frame(spark, sf).withColumns({q: (F.col("quarter") == int(q[-1])).cast("int") for q in QUARTERS})


def sql_solve(source: str, keys: str, size: str) -> str:
    """Recursive member that solves the systems of ``source`` (keys, m: rows of matrix and right side) by elimination."""
    pivot = "m[k][k]"
    return f"""solved AS (SELECT {keys}, 1 AS k, m FROM {source}
    UNION ALL SELECT {keys}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
        THEN list_transform(r, lambda v: v / {pivot})
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / {pivot}) END) FROM solved WHERE k <= {size})"""


# Straight from the definition: each fold's own training rows, imputed, standardised and solved.
_D = len(DESIGN.features)
_X = ", ".join(f"CAST({c} AS DOUBLE)" for c in DESIGN.features)
FOLD_SQL = f"""
    WITH RECURSIVE shaped AS (SELECT *, {', '.join(f'CAST(quarter = {q[-1]} AS INTEGER) AS {q}' for q in QUARTERS)} FROM model),
    n AS (SELECT count(*) AS n, count(*) // {FOLDS + 1} AS size FROM model_months),
    folds AS (SELECT CAST(f AS INTEGER) AS fold, CASE WHEN f = {FOLDS} THEN n ELSE (f + 1) * size END AS last, f * size AS cut
              FROM n, (SELECT unnest(range(1, {FOLDS + 1})) AS f) WHERE size > 0),
    base AS (SELECT fold, month_pos <= cut AS train, CAST(target_qty AS DOUBLE) AS y, [{_X}] AS x, entity, shaped.year_month
             FROM shaped JOIN model_months USING (year_month) JOIN folds ON month_pos <= last),
    cells AS (SELECT fold, unnest(x) AS v, unnest(range({_D})) AS i FROM base WHERE train),
    means AS (SELECT fold, list(mu ORDER BY i) AS mu FROM (SELECT fold, i, coalesce(avg(v), 0) AS mu FROM cells GROUP BY fold, i)
              GROUP BY fold),
    filled AS (SELECT fold, train, y, list_transform(x, lambda v, i: coalesce(v, mu[i])) AS x FROM base JOIN means USING (fold)),
    spreads AS (SELECT fold, list(sd ORDER BY i) AS sd FROM (SELECT fold, i,
                CASE WHEN stddev_pop(v) < 1e-6 * sqrt(avg(v * v)) OR stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS sd
                FROM (SELECT fold, unnest(x) AS v, unnest(range({_D})) AS i FROM filled WHERE train) GROUP BY fold, i) GROUP BY fold),
    scaled AS (SELECT fold, train, y, list_transform(x, lambda v, i: (v - mu[i]) / sd[i]) AS x
               FROM filled JOIN means USING (fold) JOIN spreads USING (fold)),
    level AS (SELECT fold, avg(y) AS my, count(*) AS n_train FROM scaled WHERE train GROUP BY fold),
    pairs AS (SELECT fold, i, j, sum(x[i] * CASE WHEN j > {_D} THEN y - my ELSE x[j] END) AS v
              FROM scaled JOIN level USING (fold), (SELECT unnest(range(1, {_D + 1})) AS i),
                   (SELECT unnest(range(1, {_D + 2})) AS j) WHERE train GROUP BY fold, i, j),
    systems AS (SELECT fold, list(r ORDER BY i) AS m FROM (
                SELECT fold, i, list(v + CASE WHEN i = j THEN {ALPHA} ELSE 0 END ORDER BY j) AS r FROM pairs GROUP BY fold, i)
                GROUP BY fold),
    {sql_solve('systems', 'fold', str(_D))},
    weights AS (SELECT fold, list_transform(m, lambda r: r[{_D + 1}]) AS w FROM solved WHERE k = {_D + 1})"""


@register("fold_ridge_coefficients", with_blocks(FOLD_SQL + f"""
    SELECT fold, [{', '.join(f"'{c}'" for c in DESIGN.features)}][i] AS feature, round(mu[i], 6) AS mean,
           round(sd[i], 6) AS scale, round(w[i], 6) AS weight
    FROM weights JOIN means USING (fold) JOIN spreads USING (fold), (SELECT unnest(range(1, {_D + 1})) AS i)""",
    "model", "model_months"))
def fold_ridge_coefficients(spark, sf):
    """The ridge model of every expanding fold, from cumulated monthly sums."""
    models = EV.expanding_ridge(fold_frame(spark, sf), DESIGN, FOLDS, ALPHA)
    return EV.coefficients(models, DESIGN).select(
        "fold", "feature", *[rnd(c, 6).alias(c) for c in ("mean", "scale", "weight")])


@register("fold_ridge_scores", with_blocks(FOLD_SQL + """,
    scored AS (SELECT fold, n_train, y, my + list_dot_product(w, x) AS p FROM scaled JOIN weights USING (fold)
               JOIN level USING (fold) WHERE NOT train)
    SELECT fold, n_train, count(*) AS n_test, round(avg(abs(y - p)), 6) AS mae,
           round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
           round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM scored GROUP BY fold, n_train""",
    "model", "model_months"))
def fold_ridge_scores(spark, sf):
    """D13 with D11 and D12: each fold's ridge model scored on the months after its training months."""
    frame = fold_frame(spark, sf)
    models = EV.expanding_ridge(frame, DESIGN, FOLDS, ALPHA)
    return EV.fold_scores(EV.predict(frame, DESIGN, models), P.TARGET)


_N = len(NUMERIC_FEATURES)
_NUMS = ", ".join(f"CAST({c} AS DOUBLE)" for c in NUMERIC_FEATURES)
_CATS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'unknown')" for c in CATEGORICAL_FEATURES)

# The prepared matrix from its definition: train medians, population scales, sorted train categories.
PREPARED_SQL = f"""
    WITH RECURSIVE raw AS (SELECT entity AS e, year_month AS ym, split = 'train' AS train, CAST(target_qty AS DOUBLE) AS y,
                                  [{_NUMS}] AS nums, [{_CATS}] AS cats FROM split),
    filled AS (SELECT e, ym, train, y, cats, list_transform(nums, lambda v, i: coalesce(v, med[i])) AS nums FROM raw,
               (SELECT list(m ORDER BY i) AS med FROM (SELECT i, quantile_cont(v, 0.5) AS m FROM (
                    SELECT unnest(nums) AS v, unnest(range({_N})) AS i FROM raw WHERE train) GROUP BY i))),
    scales AS (SELECT list(mu ORDER BY i) AS mu, list(sd ORDER BY i) AS sd FROM (
               SELECT i, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS sd
               FROM (SELECT unnest(nums) AS v, unnest(range({_N})) AS i FROM filled WHERE train) GROUP BY i)),
    slots AS (SELECT list({{'c': c, 'v': v}} ORDER BY c, v) AS slot FROM (SELECT DISTINCT c, v FROM (
              SELECT unnest(cats) AS v, unnest(range({len(CATEGORICAL_FEATURES)})) AS c FROM filled WHERE train))),
    names AS (SELECT list_concat([{', '.join(f"'{c}'" for c in NUMERIC_FEATURES)}],
              list_transform(slot, lambda s: [{', '.join(f"'{c}'" for c in CATEGORICAL_FEATURES)}][s.c + 1] || '_' || s.v)) AS names
              FROM slots),
    matrix AS (SELECT e, ym, train, y, list_concat(list_transform(nums, lambda v, i: (v - mu[i]) / sd[i]),
               list_transform(slot, lambda s: CAST(cats[s.c + 1] = s.v AS DOUBLE))) AS x FROM filled, scales, slots)"""


def _prepared(spark, sf):
    """(train, test, the preparation fitted on train, stored in the shared folder and loaded from there)."""
    s = split_frame(spark, sf)
    train, test = (s.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    path = shared_path(spark, "preparation")
    FE.Preparation.fit(train, NUMERIC_FEATURES, CATEGORICAL_FEATURES).save(path)
    return train, test, FE.Preparation.load(spark, path)


@register("prepared_features", with_blocks(PREPARED_SQL + """
    SELECT e AS entity, ym AS year_month, unnest(names) AS feature, round(unnest(x), 6) AS value
    FROM matrix, names WHERE NOT train""", "split"))
def prepared_features(spark, sf):
    """M5/M6: the test rows through the stored preparation, one row per named feature."""
    _, test, prep = _prepared(spark, sf)
    named = FE.named_features(prep.transform(test.withColumn("__entity", F.col("entity"))), prep.names,
                              ["__entity", "year_month"])
    return named.select(F.col("__entity").alias("entity"), "year_month", "feature", rnd("value", 6).alias("value"))


# Spark's ridge penalises standardised weights by n * regParam / (population deviation of the label).
@register("ridge_baseline", with_blocks(PREPARED_SQL + f""",
    width AS (SELECT CAST(max(len(x)) AS INTEGER) AS d FROM matrix),
    cols AS (SELECT unnest(range(1, d + 1)) AS i FROM width),
    spread AS (SELECT list(mu ORDER BY i) AS xm, list(sd ORDER BY i) AS xs FROM (
               SELECT i, avg(x[i]) AS mu, CASE WHEN stddev_pop(x[i]) < 1e-9 THEN 0 ELSE stddev_pop(x[i]) END AS sd
               FROM matrix, cols WHERE train GROUP BY i)),
    level AS (SELECT avg(y) AS my, count(*) * 0.1 / stddev_pop(y) AS alpha FROM matrix WHERE train),
    z AS (SELECT train, e, ym, y, list_transform(x, lambda v, i: CASE WHEN xs[i] = 0 THEN 0 ELSE (v - xm[i]) / xs[i] END) AS z
          FROM matrix, spread),
    gram AS (SELECT a.i, b.i AS j, sum(z[a.i] * z[b.i]) AS v FROM z, cols a, cols b WHERE train GROUP BY a.i, b.i
             UNION ALL SELECT i, d + 1, sum(z[i] * (y - my)) FROM z, cols, level, width WHERE train GROUP BY i, d),
    systems AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v + CASE WHEN i = j THEN alpha ELSE 0 END ORDER BY j) AS r
                FROM gram, level GROUP BY i)),
    {sql_solve('systems', '1 AS one', 'len(m)').replace('SELECT 1 AS one, k + 1', 'SELECT one, k + 1')}
    SELECT e AS entity, ym AS year_month, CAST(y AS BIGINT) AS target_qty,
           round(my + list_dot_product(list_transform(m, lambda r: r[d + 1]), z), 4) AS prediction
    FROM z, level, solved, width WHERE NOT train AND k = d + 1""", "split"))
def ridge_baseline(spark, sf):
    """A ridge regression on the prepared matrix, scored on the test months."""
    train, test, prep = _prepared(spark, sf)
    model = MO.fit_regressors(prep.transform(train), "features", P.TARGET, kinds=["ridge"])["ridge"]
    # the preparation scales target-side features only, so the target itself is still the raw quantity
    return model.transform(prep.transform(test)).select(
        "entity", "year_month", P.TARGET, rnd("prediction", 4).alias("prediction"))


_TREE_SQL = """
    SELECT s.entity, s.year_month, s.target_qty, true AS within_train_range, t.lo AS train_min, t.hi AS train_max
    FROM split s, (SELECT CAST(min(target_qty) AS DOUBLE) AS lo, CAST(max(target_qty) AS DOUBLE) AS hi
                   FROM split WHERE split = 'train') t WHERE s.split = 'test'"""


def _trees(spark, sf, kind: str):
    s = split_frame(spark, sf)
    out = MO.tree_predictions(s.where("split = 'train'"), s.where("split = 'test'"), kind, P.TARGET,
                              P.PANEL_KEYS, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    return out.select("entity", "year_month", P.TARGET,
                      F.col("prediction").between(F.col("train_min"), F.col("train_max")).alias("within_train_range"),
                      "train_min", "train_max")


@register("forest_baseline", with_blocks(_TREE_SQL, "split"))
def forest_baseline(spark, sf):
    """A random forest's predictions for the test months (SQL checks the rows and the range they lie in)."""
    return _trees(spark, sf, "random_forest")


@register("boosted_trees_baseline", with_blocks(_TREE_SQL, "split"))
def boosted_trees_baseline(spark, sf):
    """Boosted trees' predictions for the test months (SQL checks the rows and the range they lie in)."""
    return _trees(spark, sf, "gbt")
