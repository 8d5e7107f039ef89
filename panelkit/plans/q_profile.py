"""Queries for data quality and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import profile as PR
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import sql_quantile as Q, sql_sorted_list as L, with_blocks
from panelkit.plans.registry import register
from panelkit.plans.tables import table


def _panel(spark, sf):
    return P.gold_panel(spark, sf)


def _unpivot_sql(src: str, cols: list[str], keep_null: bool = False) -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols]
    body = " UNION ALL ".join(parts)
    return body if keep_null else f"SELECT * FROM ({body}) WHERE value IS NOT NULL"


@register("table_summary", with_blocks("""
    SELECT count(*) AS rows, CAST(21 AS BIGINT) AS columns, count(DISTINCT entity) AS key_count,
           min(year_month) AS min_time, max(year_month) AS max_time,
           count(target_qty) AS target_non_null, count(*) - count(target_qty) AS target_missing
    FROM panel""", "panel"))
def table_summary(spark, sf):
    return PR.table_summary(_panel(spark, sf), "entity", "year_month", P.TARGET)


@register("catalog_validation", with_blocks("""
    SELECT count(*) AS row_count, count(target_qty) AS target_rows FROM panel""", "panel"))
def catalog_validation(spark, sf):
    """Ad-hoc SQL over a registered table (temp view in the session catalog)."""
    _panel(spark, sf).createOrReplaceTempView("gold_monthly_panel")
    return spark.sql("SELECT count(*) AS row_count, count(target_qty) AS target_rows FROM gold_monthly_panel")


def _profile_sql() -> str:
    rows = []
    for i, (c, t) in enumerate(P.PANEL_SCHEMA):
        rows.append(f"""SELECT {i} AS pos, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
            count(*) - count({c}) AS nulls,
            round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct,
            count(DISTINCT {c}) AS "unique" FROM panel""")
    return with_blocks(" UNION ALL ".join(rows), "panel")


@register("column_profile", _profile_sql())
def column_profile(spark, sf):
    return PR.column_profile(_panel(spark, sf))


def _missing_sql() -> str:
    rows = [f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM panel"""
            for c, _ in P.PANEL_SCHEMA]
    return with_blocks(f"SELECT * FROM ({' UNION ALL '.join(rows)}) WHERE missing > 0 "
                       "ORDER BY missing DESC, \"column\"", "panel")


@register("missing_summary", _missing_sql())
def missing_summary(spark, sf):
    return PR.missing_summary(_panel(spark, sf))


@register("duplicate_key_count", """
    SELECT count(*) - count(DISTINCT (o_custkey, o_orderdate)) AS duplicates FROM orders""")
def duplicate_key_count(spark, sf):
    return PR.duplicate_count(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@register("missing_target_rows", with_blocks("""
    SELECT entity, year_month, target_lines, target_discount_avg FROM panel WHERE target_qty IS NULL""",
    "panel"))
def missing_target_rows(spark, sf):
    """P5: rows without target, projected."""
    return (_panel(spark, sf).where(F.col(P.TARGET).isNull())
            .select("entity", "year_month", "target_lines", "target_discount_avg"))


@register("drop_missing_target", with_blocks("""
    SELECT entity, year_month, target_qty FROM panel WHERE target_qty IS NOT NULL""", "panel"))
def drop_missing_target(spark, sf):
    """Keep rows that have a target."""
    return _panel(spark, sf).dropna(subset=[P.TARGET]).select("entity", "year_month", P.TARGET)


@register("renamed_typed_projection", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice AS amount, l_returnflag AS return_flag,
           CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
           strftime(l_shipdate, '%Y-%m') AS year_month
    FROM lineitem""")
def renamed_typed_projection(spark, sf):
    """Rename + cast projection with derived calendar columns."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("return_flag"), F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"), F.date_format("l_shipdate", "yyyy-MM").alias("year_month"))


@register("scatter_projection", with_blocks("""
    SELECT price_avg, target_qty, region_code FROM panel
    WHERE price_avg IS NOT NULL AND target_qty IS NOT NULL""", "panel"))
def scatter_projection(spark, sf):
    return PR.scatter_projection(_panel(spark, sf), "price_avg", P.TARGET, "region_code")


@register("distinct_months", with_blocks(
    "SELECT DISTINCT year_month FROM panel ORDER BY year_month", "panel"))
def distinct_months(spark, sf):
    return PR.distinct_sorted(_panel(spark, sf), "year_month")


LINE_STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("descriptive_stats", f"""
    SELECT column_name AS "column", n AS count, round(mean, 4) AS mean, round(std, 4) AS std, mn AS min,
           round({Q('v', 0.05)}, 4) AS p5, round({Q('v', 0.25)}, 4) AS p25, round({Q('v', 0.5)}, 4) AS p50,
           round({Q('v', 0.75)}, 4) AS p75, round({Q('v', 0.95)}, 4) AS p95, mx AS max
    FROM (SELECT column_name, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std,
                 min(value) AS mn, max(value) AS mx, {L('value')} AS v
          FROM ({_unpivot_sql('lineitem', LINE_STATS)}) GROUP BY column_name)""")
def descriptive_stats(spark, sf):
    return PR.describe_columns(table(spark, sf, "lineitem"), LINE_STATS, digits=4)


MODE_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@register("column_mode", f"""
    SELECT column_name AS "column", value AS mode FROM (
      SELECT column_name, value, row_number() OVER (PARTITION BY column_name
             ORDER BY (value IS NOT NULL) DESC, cnt DESC, value ASC) AS rn
      FROM (SELECT column_name, value, count(*) AS cnt
            FROM ({_unpivot_sql('lineitem', MODE_COLS, keep_null=True)}) GROUP BY ALL))
    WHERE rn = 1""")
def column_mode(spark, sf):
    return PR.column_modes(table(spark, sf, "lineitem"), MODE_COLS)


OUTLIER_COLS = ["target_qty", "target_lines", "price_avg", "ship_qty", "ship_value"]


@register("iqr_outliers", with_blocks(f"""
    WITH v AS ({_unpivot_sql('panel', OUTLIER_COLS)}),
    b AS (SELECT column_name, {Q('l', 0.25)} AS q1, {Q('l', 0.75)} AS q3
          FROM (SELECT column_name, {L('value')} AS l FROM v GROUP BY column_name))
    SELECT b.column_name AS "column", round(b.q1 - 1.5 * (b.q3 - b.q1), 6) AS lower_bound,
           round(b.q3 + 1.5 * (b.q3 - b.q1), 6) AS upper_bound,
           count(*) FILTER (WHERE v.value < b.q1 - 1.5 * (b.q3 - b.q1)
                             OR v.value > b.q3 + 1.5 * (b.q3 - b.q1)) AS outliers
    FROM v JOIN b ON v.column_name = b.column_name GROUP BY ALL""", "panel"))
def iqr_outliers(spark, sf):
    return PR.iqr_outliers(_panel(spark, sf), OUTLIER_COLS, digits=6)


@register("boxplot_stats", f"""
    WITH q AS (SELECT {Q('l', 0.25)} AS q1, {Q('l', 0.5)} AS med, {Q('l', 0.75)} AS q3
               FROM (SELECT {L('l_extendedprice')} AS l FROM lineitem))
    SELECT round(q.q1, 6) AS q1, round(q.med, 6) AS median, round(q.q3, 6) AS q3,
           min(l_extendedprice) FILTER (WHERE l_extendedprice >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
           max(l_extendedprice) FILTER (WHERE l_extendedprice <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
           count(*) FILTER (WHERE l_extendedprice < q.q1 - 1.5 * (q.q3 - q.q1)
                             OR l_extendedprice > q.q3 + 1.5 * (q.q3 - q.q1)) AS fliers,
           count(*) AS n
    FROM lineitem, q WHERE l_extendedprice IS NOT NULL GROUP BY q.q1, q.med, q.q3""")
def boxplot_stats(spark, sf):
    return PR.boxplot_stats(table(spark, sf, "lineitem"), "l_extendedprice", digits=6)


@register("histogram_bins", with_blocks("""
    WITH s AS (SELECT min(price_avg) AS lo, max(price_avg) AS hi FROM panel WHERE price_avg IS NOT NULL),
    b AS (SELECT CAST(CASE WHEN (s.hi - s.lo) / 40 = 0 THEN 0
                           ELSE least(floor((price_avg - s.lo) / ((s.hi - s.lo) / 40)), 39) END AS INTEGER) AS bin
          FROM panel, s WHERE price_avg IS NOT NULL)
    SELECT b.bin, s.lo + b.bin * ((s.hi - s.lo) / 40) AS bin_start,
           s.lo + (b.bin + 1) * ((s.hi - s.lo) / 40) AS bin_end, count(*) AS count
    FROM b, s GROUP BY b.bin, s.lo, s.hi""", "panel"))
def histogram_bins(spark, sf):
    return PR.histogram(_panel(spark, sf), "price_avg", bins=40)


CORR_COLS = ["target_qty", "target_lines", "target_avg_qty", "price_avg", "price_n_avg",
             "price_total", "total_count", "ship_qty", "ship_lines", "ship_value"]


def _corr_sql(cols: list[str], only_first: bool = False) -> str:
    pairs = [(a, b) for a in cols for b in cols]
    if only_first:
        pairs = [(cols[0], b) for b in cols]
        sel = [f"SELECT '{b}' AS \"column\", round(corr({a}, {b}), 6) AS corr FROM panel" for a, b in pairs]
        return with_blocks(" UNION ALL ".join(sel), "panel")
    sel = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM panel"
           for a, b in pairs]
    return with_blocks(" UNION ALL ".join(sel), "panel")


@register("correlation_matrix", _corr_sql(CORR_COLS))
def correlation_matrix(spark, sf):
    return PR.correlation_matrix(_panel(spark, sf), CORR_COLS)


@register("target_correlation", _corr_sql(CORR_COLS, only_first=True))
def target_correlation(spark, sf):
    return PR.target_correlation(_panel(spark, sf), P.TARGET, CORR_COLS)
