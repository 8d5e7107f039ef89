"""Queries for feature engineering and ML preparation (F-C1, F-C2, F4,
M1-M4, P9) on the panel's modelling frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd

from panelkit.functions import dates as D
from panelkit.functions import numeric as N
from panelkit.operators import features as FE
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import (DISCOUNT_EDGES, DISCOUNT_LABELS, PRICE_EDGES, PRICE_LABELS,
                                          SEGMENT_LABELS, with_blocks)
from panelkit.plans.oracle_blocks import sql_quantile as Q
from panelkit.plans.oracle_blocks import sql_sorted_list as L
from panelkit.plans.registry import register

NUMERIC_FEATURES = ["days", "price_avg", "price_n_avg", "price_total", "price_n_total", "national_count",
                    "regional_count", "total_count", "ship_qty", "ship_lines", "ship_value", "supplier_count",
                    "month", "quarter", "is_high_season", "ship_qty_log1p", "price_avg_sq", "discount_sqrt"]
CATEGORICAL_FEATURES = ["entity", "region_code", "price_bucket", "discount_bucket"]


def model_frame(spark, sf):
    """Panel rows with a target + calendar parts, transforms and buckets
    (the reference's modelling frame)."""
    m = P.gold_panel(spark, sf).dropna(subset=[P.TARGET])
    m = D.date_parts(m, "year_month")
    return m.withColumns({
        "target_qty_log1p": F.log1p(P.TARGET),
        "ship_qty_log1p": N.log1p_clipped("ship_qty"),
        "discount_sqrt": N.sqrt_clipped("target_discount_avg"),
        "price_avg_sq": F.col("price_avg") * F.col("price_avg"),
        "price_bucket": N.bucket("price_avg", PRICE_EDGES, PRICE_LABELS),
        "price_n_bucket": N.bucket("price_n_avg", PRICE_EDGES, PRICE_LABELS),
        "discount_bucket": N.bucket("target_discount_avg", DISCOUNT_EDGES, DISCOUNT_LABELS),
    })


def split_frame(spark, sf):
    return FE.split_by_month(model_frame(spark, sf), "year_month", 0.8, "split")


@register("fixed_buckets", with_blocks(
    "SELECT entity, year_month, price_bucket, price_n_bucket, discount_bucket FROM model", "model"))
def fixed_buckets(spark, sf):
    return model_frame(spark, sf).select("entity", "year_month", "price_bucket", "price_n_bucket",
                                         "discount_bucket")


@register("quantile_segments", with_blocks(f"""
    SELECT entity, year_month, target_qty,
           CASE WHEN target_qty <= q1 THEN 'low' WHEN target_qty <= q2 THEN 'medium'
                WHEN target_qty <= q3 THEN 'high' ELSE 'very_high' END AS demand_segment
    FROM model, (SELECT {Q('l', 0.25)} AS q1, {Q('l', 0.5)} AS q2, {Q('l', 0.75)} AS q3
                 FROM (SELECT {L('target_qty')} AS l FROM model))""", "model"))
def quantile_segments(spark, sf):
    m = FE.quantile_bucket(model_frame(spark, sf), P.TARGET, SEGMENT_LABELS, "demand_segment")
    return m.select("entity", "year_month", P.TARGET, "demand_segment")


@register("temporal_split", with_blocks("SELECT entity, year_month, split FROM split", "split"))
def temporal_split(spark, sf):
    return split_frame(spark, sf).select("entity", "year_month", "split")


@register("split_summary", with_blocks("""
    SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
           count(*) FILTER (WHERE split = 'test') AS test_rows,
           round(count(*) FILTER (WHERE split = 'train') / count(*), 3) AS train_pct,
           round(count(*) FILTER (WHERE split = 'test') / count(*), 3) AS test_pct,
           min(year_month) FILTER (WHERE split = 'train') AS train_month_min,
           max(year_month) FILTER (WHERE split = 'train') AS train_month_max,
           min(year_month) FILTER (WHERE split = 'test') AS test_month_min,
           max(year_month) FILTER (WHERE split = 'test') AS test_month_max,
           (SELECT count(*) FROM (SELECT year_month FROM split WHERE split = 'train'
                                  INTERSECT SELECT year_month FROM split WHERE split = 'test')) AS month_overlap
    FROM split""", "split"))
def split_summary(spark, sf):
    s = split_frame(spark, sf)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    overlap = (train.select("year_month").intersect(test.select("year_month"))
               .select(F.count(F.lit(1))).scalar())
    is_tr = F.col("split") == "train"
    is_te = F.col("split") == "test"
    return s.agg(
        F.count_if(is_tr).alias("train_rows"), F.count_if(is_te).alias("test_rows"),
        rnd(F.count_if(is_tr) / F.count(F.lit(1)), 3).alias("train_pct"),
        rnd(F.count_if(is_te) / F.count(F.lit(1)), 3).alias("test_pct"),
        F.min(F.when(is_tr, F.col("year_month"))).alias("train_month_min"),
        F.max(F.when(is_tr, F.col("year_month"))).alias("train_month_max"),
        F.min(F.when(is_te, F.col("year_month"))).alias("test_month_min"),
        F.max(F.when(is_te, F.col("year_month"))).alias("test_month_max"),
        F.first(overlap).alias("month_overlap"))


IMPUTE_COLS = ["price_n_avg", "price_n_total"]


@register("median_impute", with_blocks(f"""
    SELECT entity, year_month, round(coalesce(price_n_avg, m.a), 4) AS price_n_avg,
           round(coalesce(price_n_total, m.t), 4) AS price_n_total
    FROM split, (SELECT {Q('la', 0.5)} AS a, {Q('lt', 0.5)} AS t
                 FROM (SELECT {L('price_n_avg')} AS la, {L('price_n_total')} AS lt FROM split
                       WHERE split = 'train')) m""", "split"))
def median_impute(spark, sf):
    s = split_frame(spark, sf)
    med = FE.fit_medians(s.where(F.col("split") == "train"), IMPUTE_COLS)
    out = FE.apply_medians(s, med)
    return out.select("entity", "year_month", *[rnd(c, 4).alias(c) for c in IMPUTE_COLS])


@register("constant_impute", with_blocks("""
    SELECT entity, year_month, coalesce(price_n_bucket, 'unknown') AS price_n_bucket,
           coalesce(discount_bucket, 'unknown') AS discount_bucket FROM model""", "model"))
def constant_impute(spark, sf):
    m = FE.fill_constant(model_frame(spark, sf), ["price_n_bucket", "discount_bucket"])
    return m.select("entity", "year_month", "price_n_bucket", "discount_bucket")


SCALE_COLS = ["price_avg", "ship_qty", "total_count", "supplier_count"]


def _scale_sql() -> str:
    sel = []
    for c in SCALE_COLS:
        sel.append(f"""round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM split WHERE split = 'train'))
            / (SELECT CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 OR stddev_pop(CAST({c} AS DOUBLE)) IS NULL
                           THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END FROM split WHERE split = 'train'), 6) AS {c}""")
    return with_blocks(f"SELECT entity, year_month, {', '.join(sel)} FROM split", "split")


@register("standard_scale", _scale_sql())
def standard_scale(spark, sf):
    s = split_frame(spark, sf)
    sc = FE.fit_scaler(s.where(F.col("split") == "train"), SCALE_COLS)
    out = FE.apply_scaler(s, sc, SCALE_COLS)
    return out.select("entity", "year_month", *[rnd(c, 6).alias(c) for c in SCALE_COLS])


@register("one_hot", with_blocks("""
    WITH cats AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS slot
                  FROM (SELECT DISTINCT CAST(year AS VARCHAR) AS category FROM split WHERE split = 'train'))
    SELECT s.entity, s.year_month, CAST(s.year AS VARCHAR) AS year_cat, c.slot AS year_cat_slot,
           (SELECT count(*) FROM cats) AS year_cat_width
    FROM split s LEFT JOIN cats c ON CAST(s.year AS VARCHAR) = c.category""", "split"))
def one_hot(spark, sf):
    """M4: slot of the year category among sorted train categories; years
    seen only in test get no slot (an all-zero row)."""
    s = split_frame(spark, sf).withColumn("year_cat", F.col("year").cast("string"))
    train = s.where(F.col("split") == "train")
    out = FE.one_hot_slot(s, train, "year_cat")
    return out.select("entity", "year_month", "year_cat", F.col("year_cat_slot").cast("int"), "year_cat_width")


EXCLUDED = ["feature_source", "target_available", "date", "target_qty_log1p", "target_lines",
            "target_avg_qty", "target_discount_avg"]
MODEL_COLUMNS_SQL_ORDER = ["entity", "year_month"] + NUMERIC_FEATURES + ["region_code", "price_bucket",
                                                                          "discount_bucket", P.TARGET]


_MODEL_SQL_COLS = [f"round({c}, 6) AS {c}" if c == "ship_qty_log1p" else c for c in MODEL_COLUMNS_SQL_ORDER]


@register("model_matrix_columns", with_blocks(f"SELECT {', '.join(_MODEL_SQL_COLS)} FROM model", "model"))
def model_matrix_columns(spark, sf):
    """The modelling columns after the leakage-safe exclusions."""
    m = FE.model_columns(model_frame(spark, sf), EXCLUDED)
    # log1p differs from ln(1 + x) in the last bit between engines: round it.
    return m.withColumn("ship_qty_log1p", rnd("ship_qty_log1p", 6)).select(*MODEL_COLUMNS_SQL_ORDER)
