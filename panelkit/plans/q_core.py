"""Queries for the integration core: rollups, joins, filters, sets, keyed
selection (A1-A4, J1-J8, P1-P7, U1-U4, S9, S10, O1-O4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import with_blocks
from panelkit.plans.registry import register
from panelkit.plans.tables import table


@register("monthly_feature_panel", with_blocks("SELECT * FROM panel", "panel"))
def monthly_feature_panel(spark, sf):
    return P.monthly_feature_panel(spark, sf)


@register("monthly_rollup", with_blocks("SELECT * FROM monthly", "monthly"))
def monthly_rollup(spark, sf):
    return P.monthly(P.daily(spark, sf))


@register("entity_rollup", with_blocks("SELECT * FROM sup_rollup", "sup_rollup"))
def entity_rollup(spark, sf):
    return P.supplier_rollup(spark, sf)


@register("scoped_counts", with_blocks("SELECT * FROM cal_counts", "cal_counts"))
def scoped_counts(spark, sf):
    return P.calendar_counts(P.daily(spark, sf))


from panelkit.functions.dates import ym_of
from panelkit.operators import joins as J
from panelkit.operators import sets as U
from panelkit.plans.oracle_blocks import sql_normalize


@register("membership_filter", """
    SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m') AS year_month,
           o_orderpriority AS priority
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def membership_filter(spark, sf):
    o = table(spark, sf, "orders")
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.col("o_orderkey").alias("order_key"), ym_of("o_orderdate").alias("year_month"),
        F.col("o_orderpriority").alias("priority"))


def where_trimmed_equals(df, col, value):
    """Equality on stripped text (`` Total `` == ``Total``)."""
    from panelkit.functions.text import strip_ws
    return df.where(strip_ws(col) == F.lit(value))


@register("trimmed_equality_filter", """
    SELECT c_custkey, c_name, ' ' || c_mktsegment || '  ' AS segment_raw
    FROM customer WHERE trim(' ' || c_mktsegment || '  ') = 'BUILDING'""")
def trimmed_equality_filter(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit(" "), "c_mktsegment", F.lit("  ")).alias("segment_raw"))
    return where_trimmed_equals(c, "segment_raw", "BUILDING")


def mapped_nations(spark, sf):
    """A partial nation dimension: nations outside the MIDDLE EAST region."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").where(F.col("r_name") != "MIDDLE EAST")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left_semi").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")


MAPPED_NATIONS_SQL = """(SELECT n.n_nationkey AS c_nationkey, n.n_name FROM nation n
    WHERE n.n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name <> 'MIDDLE EAST'))"""


@register("dimension_lookup", f"""
    SELECT c.c_custkey, c.c_nationkey, coalesce(m.n_name, CAST(c.c_nationkey AS VARCHAR)) AS nation_name
    FROM customer c LEFT JOIN {MAPPED_NATIONS_SQL} m ON c.c_nationkey = m.c_nationkey""")
def dimension_lookup(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # The mapped-nation dimension is checked explicitly (bounded row count).
    out = J.lookup(c, mapped_nations(spark, sf), "c_nationkey", max_dim_rows=10_000)
    return out.select("c_custkey", "c_nationkey",
                      F.coalesce("n_name", F.col("c_nationkey").cast("string")).alias("nation_name"))


@register("unmapped_keys", f"""
    SELECT DISTINCT c_nationkey FROM customer
    WHERE c_nationkey NOT IN (SELECT c_nationkey FROM {MAPPED_NATIONS_SQL} m)""")
def unmapped_keys(spark, sf):
    c = table(spark, sf, "customer")
    return J.unmapped(c, mapped_nations(spark, sf), "c_nationkey")


@register("pending_keys", with_blocks("""
    SELECT m.entity, m.year_month FROM monthly m
    WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.entity = m.entity AND t.year_month = m.year_month)""",
    "monthly", "target"))
def pending_keys(spark, sf):
    """Planned (entity, month) keys that have not landed on the target side."""
    plan = P.silver_monthly(spark, sf).select(*P.PANEL_KEYS)
    landed = P.target_side(spark, sf)
    return J.drop_known(plan, landed, P.PANEL_KEYS)


def alias_inputs(spark, sf):
    """Raw nation spellings per customer: exact, lower case, spaced alias,
    accented, and an unknown suffix (passes through raw)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = c.join(n, "c_nationkey")
    seg = F.col("c_mktsegment")
    raw = (F.when(seg == "BUILDING", F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
            .when(seg == "AUTOMOBILE", F.regexp_replace("n_name", "_", " "))
            .when(seg == "MACHINERY", F.concat("n_name", F.lit(" X")))
            .when(seg == "HOUSEHOLD", F.regexp_replace("n_name", "A", "Á"))
            .otherwise(F.col("n_name")))
    return j.select("c_custkey", raw.alias("raw"))


@register("alias_resolution", f"""
    WITH raw AS (
      SELECT c.c_custkey,
             CASE WHEN c.c_mktsegment = 'BUILDING' THEN '  ' || lower(n.n_name) || ' '
                  WHEN c.c_mktsegment = 'AUTOMOBILE' THEN replace(n.n_name, '_', ' ')
                  WHEN c.c_mktsegment = 'MACHINERY' THEN n.n_name || ' X'
                  WHEN c.c_mktsegment = 'HOUSEHOLD' THEN replace(n.n_name, 'A', 'Á')
                  ELSE n.n_name END AS raw
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
    aliases AS (SELECT {sql_normalize("replace(n_name, '_', ' ')")} AS k, min(n_name) AS target
                FROM nation GROUP BY 1),
    canon AS (SELECT {sql_normalize('n_name')} AS k, min(n_name) AS name FROM nation GROUP BY 1),
    keyed AS (SELECT c_custkey, raw, {sql_normalize('raw')} AS k FROM raw)
    SELECT keyed.c_custkey, keyed.raw,
           CASE WHEN keyed.k = '' THEN '' ELSE coalesce(a.target, cn.name, trim(keyed.raw)) END AS resolved
    FROM keyed LEFT JOIN aliases a ON keyed.k = a.k LEFT JOIN canon cn ON keyed.k = cn.k""")
def alias_resolution(spark, sf):
    n = table(spark, sf, "nation")
    aliases = n.select(F.regexp_replace("n_name", "_", " ").alias("alias"), F.col("n_name").alias("target"))
    canonical = n.select(F.col("n_name").alias("name"))
    return J.resolve_alias(alias_inputs(spark, sf), "raw", aliases, canonical, out="resolved")


@register("anti_join_dedupe", with_blocks("""
    SELECT DISTINCT r.day, r.region_code, r.label
    FROM (SELECT c.day, c.region_code, d.status AS label FROM calendar c JOIN daily d ON c.order_key = d.order_key
          WHERE c.scope = 'regional') r
    WHERE NOT EXISTS (
      SELECT 1 FROM calendar c2 JOIN daily d2 ON c2.order_key = d2.order_key
      WHERE c2.scope = 'national' AND c2.day = r.day AND d2.status = r.label)""", "calendar"))
def anti_join_dedupe(spark, sf):
    cal = P.calendar(P.daily(spark, sf), ("status",)).withColumnRenamed("status", "label")
    national = cal.where(F.col("scope") == "national").select("day", "label")
    regional = cal.where(F.col("scope") == "regional").select("day", "region_code", "label")
    return J.drop_known(regional, national, ["day", "label"]).dropDuplicates()


EVENT_BLOCK_TYPES = ["view", "click", "purchase"]


def event_blocks(spark, sf):
    """Three metric blocks keyed by user: event counts per type."""
    e = table(spark, sf, "events").where(F.col("event_type").isin(EVENT_BLOCK_TYPES))
    return e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("value"))


def pivot_metrics(blocks, key, metric_col, metrics, value_col="value", fill=0):
    """Merge metric blocks on the key (a full outer merge); an absent
    metric is ``fill``. Explicit pivot values avoid an extra distinct job."""
    wide = blocks.groupBy(key).pivot(metric_col, metrics).agg(F.first(value_col))
    return wide.select(key, *[F.coalesce(F.col(m), F.lit(fill)).alias(m) for m in metrics])


@register("metric_pivot_outer", """
    SELECT coalesce(v.user_id, c.user_id, p.user_id) AS user_id,
           coalesce(v.n, 0) AS view, coalesce(c.n, 0) AS click, coalesce(p.n, 0) AS purchase
    FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) v
    FULL OUTER JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) c
      ON v.user_id = c.user_id
    FULL OUTER JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) p
      ON coalesce(v.user_id, c.user_id) = p.user_id""")
def metric_pivot_outer(spark, sf):
    return pivot_metrics(event_blocks(spark, sf), "user_id", "event_type", EVENT_BLOCK_TYPES)


@register("key_union", """
    SELECT user_id FROM events WHERE event_type = 'view'
    UNION SELECT user_id FROM events WHERE event_type = 'click'
    UNION SELECT user_id FROM events WHERE event_type = 'purchase'""")
def key_union(spark, sf):
    e = table(spark, sf, "events")
    parts = [e.where(F.col("event_type") == t).select("user_id") for t in EVENT_BLOCK_TYPES]
    return U.key_union(parts)


@register("key_except", """
    SELECT strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem
    EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders""")
def key_except(spark, sf):
    """Shipping months that have no order month."""
    a = table(spark, sf, "lineitem").select(ym_of("l_shipdate").alias("year_month"))
    b = table(spark, sf, "orders").select(ym_of("o_orderdate").alias("year_month"))
    return U.key_except(a, b)


@register("key_intersect", """
    SELECT strftime(o_orderdate, '%Y-%m') AS year_month FROM orders
    INTERSECT SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem""")
def key_intersect(spark, sf):
    a = table(spark, sf, "orders").select(ym_of("o_orderdate").alias("year_month"))
    b = table(spark, sf, "lineitem").select(ym_of("l_shipdate").alias("year_month"))
    return U.key_intersect(a, b)


@register("union_all_sources", """
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal
    FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def union_all_sources(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
    s = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return U.union_all([c, s])


@register("next_match_window", """
    SELECT v.event_id, v.user_id, v.ts, min(p.ts) AS next_purchase_ts
    FROM events v
    LEFT JOIN events p ON p.user_id = v.user_id AND p.event_type = 'purchase' AND p.ts > v.ts
    WHERE v.event_type = 'view'
    GROUP BY v.event_id, v.user_id, v.ts""")
def next_match_window(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    e = e.withColumn("__t", F.unix_micros(F.col("ts").cast("timestamp")))
    m = J.next_match(e, ["user_id"], "__t", F.col("event_type") == "purchase", "__next")
    return m.where(F.col("event_type") == "view").select(
        "event_id", "user_id", "ts",
        F.timestamp_micros("__next").cast("timestamp_ntz").alias("next_purchase_ts"))


@register("latest_per_key", """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def latest_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return J.latest_per_key(e, ["user_id"], ["ts", "event_id"])


@register("top_k_per_group", """
    SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
      SELECT o_custkey, o_orderkey, o_totalprice,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER)
               AS rank
      FROM orders) WHERE rank <= 3""")
def top_k_per_group(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return J.top_k(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@register("head_rows", """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 5""")
def head_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.orderBy("o_orderdate", "o_orderkey").limit(5)


@register("sorted_panel", with_blocks(
    "SELECT entity, year_month, days, price_avg FROM monthly ORDER BY entity, year_month", "monthly"))
def sorted_panel(spark, sf):
    return P.silver_monthly(spark, sf).select("entity", "year_month", "days", "price_avg") \
        .orderBy("entity", "year_month")
