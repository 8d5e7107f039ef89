"""Queries for the documented extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import dates as D
from panelkit.functions.numeric import rnd
from panelkit.operators import features as FE
from panelkit.operators import models as MO
from panelkit.operators import timeseries as TS
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import sql_cent_avg, with_blocks
from panelkit.plans.q_features import split_frame
from panelkit.plans.registry import register

KEYS = ["entity"]


def _monthly_idx(spark, sf):
    m = P.silver_monthly(spark, sf)
    return m.withColumn("month_idx", D.month_index("year_month"))


@register("monthly_lags", with_blocks("""
    SELECT m.entity, m.year_month, m.price_avg, l1.price_avg AS price_avg_lag1, l12.price_avg AS price_avg_lag12
    FROM monthly_idx m
    LEFT JOIN monthly_idx l1 ON l1.entity = m.entity AND l1.month_idx = m.month_idx - 1
    LEFT JOIN monthly_idx l12 ON l12.entity = m.entity AND l12.month_idx = m.month_idx - 12""", "monthly_idx"))
def monthly_lags(spark, sf):
    m = _monthly_idx(spark, sf).select("entity", "year_month", "month_idx", "price_avg")
    out = TS.add_lags(m, KEYS, "month_idx", ["price_avg"], [1, 12])
    return out.select("entity", "year_month", "price_avg", "price_avg_lag1", "price_avg_lag12")


@register("rolling_mean", with_blocks("""
    SELECT m.entity, m.year_month, m.price_avg,
           (SELECT round(avg(p.price_avg), 6) FROM monthly_idx p
             WHERE p.entity = m.entity AND p.month_idx BETWEEN m.month_idx - 3 AND m.month_idx - 1) AS price_avg_mean3
    FROM monthly_idx m""", "monthly_idx"))
def rolling_mean(spark, sf):
    m = _monthly_idx(spark, sf).select("entity", "year_month", "month_idx", "price_avg")
    out = TS.rolling_mean(m, KEYS, "month_idx", ["price_avg"], n=3, digits=6)
    return out.select("entity", "year_month", "price_avg", "price_avg_mean3")


@register("year_over_year", with_blocks("""
    SELECT m.entity, m.year_month, m.price_total, l.price_total AS price_total_lag12,
           round(CASE WHEN l.price_total = 0 THEN NULL
                      ELSE (m.price_total - l.price_total) / l.price_total END, 4) AS price_total_yoy
    FROM monthly_idx m
    LEFT JOIN monthly_idx l ON l.entity = m.entity AND l.month_idx = m.month_idx - 12""", "monthly_idx"))
def year_over_year(spark, sf):
    m = _monthly_idx(spark, sf).select("entity", "year_month", "month_idx", "price_total")
    out = TS.year_over_year(m, KEYS, "month_idx", ["price_total"])
    return out.select("entity", "year_month", "price_total", "price_total_lag12", "price_total_yoy")


PERIOD = ("1997-01", "1998-12")


@register("period_flag", with_blocks(f"""
    SELECT entity, year_month, year_month BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}' AS in_period
    FROM monthly""", "monthly"))
def period_flag(spark, sf):
    """A fixed calendar period flag (the reference's pandemic window, moved
    onto the driver tables' time span)."""
    m = P.silver_monthly(spark, sf)
    return m.select("entity", "year_month", D.period_flag("year_month", *PERIOD).alias("in_period"))


@register("season_week", """
    SELECT o_orderkey,
           CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
                WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
           CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week
    FROM orders""")
def season_week(spark, sf):
    from panelkit.plans.tables import table
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.season(F.month("o_orderdate")).alias("season"),
                    F.weekofyear("o_orderdate").alias("iso_week"))


@register("conditional_day_count", with_blocks("""
    SELECT entity, year_month, count(*) FILTER (WHERE price > 300000) AS high_value_orders,
           count(*) FILTER (WHERE price_n IS NULL) AS pending_orders,
           count(DISTINCT day) FILTER (WHERE price > 300000) AS high_value_days
    FROM daily GROUP BY entity, year_month""", "daily"))
def conditional_day_count(spark, sf):
    high = F.col("price") > 300000
    return TS.conditional_counts(P.daily(spark, sf), ["entity", "year_month"], {
        "high_value_orders": high, "pending_orders": F.col("price_n").isNull()},
        distinct={"high_value_days": ("day", high)})


@register("weekly_mean", with_blocks("""
    SELECT entity, CAST(yearweek(day) AS INTEGER) AS iso_year_week,
           """ + sql_cent_avg("price") + """ AS price_week_avg,
           count(*) AS orders
    FROM daily GROUP BY entity, yearweek(day)""", "daily"))
def weekly_mean(spark, sf):
    """Weekly mean per entity on ISO weeks (``isoyear*100 + week``)."""
    from panelkit.functions.numeric import exact_avg
    d = P.daily(spark, sf)
    yw = (F.year(F.date_add(F.date_sub("day", F.weekday("day")), 3)) * 100 + F.weekofyear("day"))
    return d.groupBy("entity", yw.alias("iso_year_week")).agg(
        rnd(exact_avg("price", 2), 4).alias("price_week_avg"), F.count(F.lit(1)).alias("orders"))


@register("ratio_features", with_blocks("""
    SELECT entity, year_month,
           round(CASE WHEN ship_value = 0 THEN NULL ELSE price_total / ship_value END, 4) AS price_per_ship_value,
           round(CASE WHEN ship_qty = 0 THEN NULL ELSE target_qty / ship_qty END, 4) AS target_per_ship_qty,
           round(CASE WHEN supplier_count = 0 THEN NULL ELSE CAST(ship_value AS DOUBLE) / supplier_count END, 4)
             AS value_per_supplier
    FROM panel""", "panel"))
def ratio_features(spark, sf):
    from panelkit.functions.numeric import safe_ratio
    p = P.gold_panel(spark, sf)
    return p.select("entity", "year_month",
                    safe_ratio("price_total", "ship_value").alias("price_per_ship_value"),
                    safe_ratio(P.TARGET, "ship_qty").alias("target_per_ship_qty"),
                    safe_ratio("ship_value", "supplier_count").alias("value_per_supplier"))


@register("bridge_days", with_blocks("""
    WITH hol AS (SELECT DISTINCT day FROM calendar WHERE scope = 'national'),
    cand AS (SELECT CASE WHEN isodow(day) = 2 THEN day - 1 WHEN isodow(day) = 4 THEN day + 1 END AS bridge_day,
                    day AS because_of FROM hol)
    SELECT CAST(bridge_day AS DATE) AS bridge_day, because_of FROM cand
    WHERE bridge_day IS NOT NULL AND bridge_day NOT IN (SELECT day FROM hol)""", "calendar"))
def bridge_days(spark, sf):
    cal = P.calendar(P.daily(spark, sf)).where(F.col("scope") == "national").select(F.col("day").alias("date"))
    return TS.bridge_days(cal, "date")


@register("completeness_check", with_blocks("""
    SELECT CAST(year(day) AS INTEGER) AS year, count(DISTINCT month(day)) AS months
    FROM daily GROUP BY year(day) HAVING count(DISTINCT month(day)) <> 12""", "daily"))
def completeness_check(spark, sf):
    d = P.daily(spark, sf).select(F.year("day").alias("year"), F.month("day").alias("month"))
    return TS.completeness(d, "year", "month")


FOLDS = 3


@register("expanding_folds", with_blocks(f"""
    WITH n AS (SELECT count(*) AS n FROM model_months),
    tagged AS (
      SELECT m.year_month, f.fold,
             CASE WHEN mm.month_pos <= f.fold * floor(n.n / {FOLDS + 1}) THEN 'train'
                  WHEN mm.month_pos <= (f.fold + 1) * floor(n.n / {FOLDS + 1})
                       OR (f.fold = {FOLDS} AND mm.month_pos <= n.n) THEN 'test' END AS role
      FROM model m JOIN model_months mm ON m.year_month = mm.year_month, n,
           (SELECT unnest(range(1, {FOLDS + 1})) AS fold) f)
    SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS rows, min(year_month) AS month_min,
           max(year_month) AS month_max
    FROM tagged WHERE role IS NOT NULL GROUP BY fold, role""", "model_months"))
def expanding_folds(spark, sf):
    from panelkit.plans.q_features import model_frame
    t = FE.expanding_folds(model_frame(spark, sf), "year_month", FOLDS)
    return t.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"),
                                         F.min("year_month").alias("month_min"),
                                         F.max("year_month").alias("month_max"))


@register("regression_metrics", with_blocks("""
    WITH base AS (SELECT entity, avg(target_qty) AS pred FROM split WHERE split = 'train' GROUP BY entity),
    scored AS (SELECT s.target_qty AS y, b.pred AS p FROM split s JOIN base b ON s.entity = b.entity
               WHERE s.split = 'test' AND s.target_qty IS NOT NULL AND b.pred IS NOT NULL),
    mean AS (SELECT avg(y) AS my FROM scored)
    SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
           round(1 - sum((y - p) * (y - p)) / sum((y - my) * (y - my)), 6) AS r2
    FROM scored, mean""", "split"))
def regression_metrics(spark, sf):
    """Metrics of a per-entity train-mean baseline on the test months."""
    s = split_frame(spark, sf)
    base = (s.where(F.col("split") == "train").groupBy("entity")
             .agg(F.avg(P.TARGET).alias("prediction")))
    scored = s.where(F.col("split") == "test").join(base, "entity")
    return MO.regression_metrics(scored, P.TARGET, "prediction")


@register("stream_daily_window", """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_total
    FROM events GROUP BY CAST(ts AS DATE), event_type""")
def stream_daily_window(spark, sf):
    """Events through a Structured Streaming daily window (file source,
    availableNow); equals the batch daily aggregate."""
    from panelkit.streaming.daily import run_daily_window
    return run_daily_window(spark, f"{sf.rstrip('/')}/events.parquet")


PERIOD_DAYS, WATERMARK_DAYS, STATE_PARTITIONS = 10, 2, 4


@register("stream_daily_append", f"""
    WITH first AS (SELECT *, (CAST(ts AS DATE) - DATE '1970-01-01') // {PERIOD_DAYS} + CASE event_id % 20 WHEN 0 THEN 1 WHEN 1 THEN 2
                          ELSE 0 END AS file FROM events),
    arrivals AS (SELECT * FROM first UNION ALL SELECT * REPLACE (file + 1 AS file) FROM first WHERE event_id % 7 = 0),
    files AS (SELECT file, max(date_trunc('second', ts)) AS latest FROM arrivals GROUP BY file),
    marks AS (SELECT file, max(latest) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                           - INTERVAL {WATERMARK_DAYS} DAY AS mark FROM files),
    counted AS (SELECT f.* FROM first f JOIN marks USING (file) WHERE mark IS NULL OR date_trunc('second', ts) > mark)
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_total
    FROM counted WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(latest) - INTERVAL {WATERMARK_DAYS} DAY FROM files)
    GROUP BY CAST(ts AS DATE), event_type""")
def stream_daily_append(spark, sf):
    """Events that land file by file, some late and some repeated, as an append stream of closed days.

    An event lands in the file of its 10-day period; of twenty ids one lands a
    file later and one two files later, and every seventh event lands again in
    the next file. Days close two days behind the latest event;
    what lands behind that mark is dropped, and repeats count once.
    """
    from panelkit.session import shared_path
    from panelkit.streaming import daily as ST

    lag = F.expr("CASE event_id % 20 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END")
    events = P.table(spark, sf, "events").withColumn(
        "file", F.floor(F.unix_date(F.to_date("ts")) / PERIOD_DAYS) + lag)
    again = events.where("event_id % 7 = 0").withColumn("file", F.col("file") + 1)
    landed = shared_path(spark, "landed-events")
    events.unionByName(again).write.partitionBy("file").parquet(landed)
    base = shared_path(spark, "stream-daily-append")
    for row in spark.read.parquet(landed).select("file").distinct().orderBy("file").toLocalIterator():
        # one arrival after the other; the sources' checkpoint remembers what it has read
        spark.read.parquet(landed).where(F.col("file") == row["file"]).drop("file").write.mode("append").parquet(f"{base}/in")
        ST.append_daily(spark.readStream.schema(ST.EVENT_SCHEMA).parquet(f"{base}/in"), base,
                        watermark=f"{WATERMARK_DAYS} days", state_partitions=STATE_PARTITIONS)
    return ST.read_daily(spark, base)
