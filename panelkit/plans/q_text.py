"""Queries for scalar functions and file-side operators over the driver
tables (F-S*, F-D*, F-M*, F-J1, F-A1, F-U1, S1, S2, S6-S8, S11, S12, S16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.numeric import rnd

from panelkit.functions import dates as D
from panelkit.functions import numeric as N
from panelkit.functions import text as X
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import sql_normalize, with_blocks
from panelkit.plans.registry import register
from panelkit.plans.tables import table
from panelkit.sources import files as S


def _sql_entity_name(expr: str) -> str:
    """The entity-name rules, written out: no trailing (*) mark, / is -, no blanks around -, one - for several."""
    return f"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({sql_normalize(expr)},
        '\\s*\\(\\*+\\)\\s*$', ''), '[ \\t\\r\\n]*/[ \\t\\r\\n]*', '-', 'g'), ' *- *', '-', 'g'),
        '--+', '-', 'g'), ' +', ' ', 'g'))"""


@register("normalize_text", f"SELECT doc_id, {sql_normalize('text')} AS normalized FROM documents")
def normalize_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.normalize_text("text").alias("normalized"))


@register("normalize_entity_name", f"SELECT doc_id, {_sql_entity_name('text')} AS entity_name FROM documents")
def normalize_entity_name(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.normalize_entity_name("text").alias("entity_name"))


@register("title_case", f"""
    SELECT doc_id, array_to_string(list_transform(
             regexp_extract_all({_sql_entity_name('text')}, '(\\pL+|\\PL+)'),
             lambda r: upper(r[1]) || lower(r[2:])), '') AS title
    FROM documents""")
def title_case(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.title_case(X.normalize_entity_name("text")).alias("title"))


@register("slugify", """
    SELECT page_id, lower(trim(regexp_replace(url, '[^a-zA-Z0-9_]+', '_', 'g'), '_')) AS slug FROM pages""")
def slugify(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.slugify("url").alias("slug"))


@register("string_predicates", """
    SELECT page_id, starts_with(url, 'https://') AS is_https, contains(url, '?') AS has_query,
           ends_with(url, '#top') AS has_top_anchor, substring(url, 1, 5) AS scheme_head,
           contains(html, '<title>') AS has_title
    FROM pages""")
def string_predicates(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.col("url").startswith("https://").alias("is_https"),
                    F.col("url").contains("?").alias("has_query"),
                    F.col("url").endswith("#top").alias("has_top_anchor"),
                    F.substring("url", 1, 5).alias("scheme_head"),
                    F.col("html").contains("<title>").alias("has_title"))


_SQL_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1))"
_SQL_SCHEME = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
ALLOWED_DOMAINS = ["example.com", "example.org"]


@register("url_policy", f"""
    SELECT page_id, {_SQL_HOST} AS host,
           ({_SQL_SCHEME} = 'https' AND ({_SQL_HOST} = 'example.com' OR ends_with({_SQL_HOST}, '.example.com')
             OR {_SQL_HOST} = 'example.org' OR ends_with({_SQL_HOST}, '.example.org'))) AS allowed,
           ({_SQL_SCHEME} = 'https' AND (ends_with({_SQL_HOST}, 'example.com')
             OR ends_with({_SQL_HOST}, 'example.org'))) AS allowed_suffix_only
    FROM pages""")
def url_policy(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.url_host("url").alias("host"),
                    X.url_allowed("url", ALLOWED_DOMAINS).alias("allowed"),
                    X.url_allowed("url", ALLOWED_DOMAINS, strict=False).alias("allowed_suffix_only"))


def _payloads(spark, sf):
    """Pages and documents as one payload table (url, content)."""
    p = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                         "url", F.col("html").alias("content"))
    d = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        F.concat(F.lit("https://docs.example.org/"), "source", F.lit("/"), "doc_id",
                 F.when(F.col("lang") == "en", F.lit(".txt")).otherwise(F.lit(""))).alias("url"),
        F.col("text").alias("content"))
    return p.unionByName(d)


_SQL_PAYLOADS = """
    SELECT 'page' AS kind, page_id AS id, url, html AS content FROM pages
    UNION ALL
    SELECT 'document', doc_id, 'https://docs.example.org/' || source || '/' || doc_id ||
           CASE WHEN lang = 'en' THEN '.txt' ELSE '' END, text FROM documents"""
_SQL_SUFFIX = ("regexp_extract(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1),"
               " '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1)")
_SQL_SNIFF = f"""CASE WHEN {_SQL_SUFFIX} <> '' THEN {_SQL_SUFFIX}
      WHEN starts_with(regexp_replace(content, '^[ \\t\\n\\r\\x0b\\x0c]+', ''), '{{') THEN '.json'
      WHEN starts_with(content, 'PK') THEN '.xlsx'
      WHEN contains(substring(content, 1, 2048), ';') THEN '.csv'
      ELSE '.bin' END"""


@register("payload_sniff", f"SELECT kind, id, {_SQL_SNIFF} AS suffix FROM ({_SQL_PAYLOADS})")
def payload_sniff(spark, sf):
    p = _payloads(spark, sf)
    return p.select("kind", "id", S.sniff_payload("url", F.lit(None), "content").alias("suffix"))


@register("payload_validation", f"""
    SELECT kind, id, suffix,
           CASE WHEN strlen(content) < 100 THEN 'too_small'
                WHEN starts_with(lower(regexp_replace(content, '^[ \\t\\n\\r\\x0b\\x0c]+', '')), '<!doctype html')
                  OR starts_with(lower(regexp_replace(content, '^[ \\t\\n\\r\\x0b\\x0c]+', '')), '<html') THEN 'html'
                WHEN suffix = '.xlsx' AND NOT starts_with(content, 'PK') THEN 'not_xlsx' END AS reject_reason
    FROM (SELECT *, {_SQL_SNIFF} AS suffix FROM ({_SQL_PAYLOADS}))""")
def payload_validation(spark, sf):
    p = _payloads(spark, sf).withColumn("suffix", S.sniff_payload("url", F.lit(None), "content"))
    return p.select("kind", "id", "suffix", S.reject_reason("content", "suffix").alias("reject_reason"))


@register("filename_fields", with_blocks("""
    SELECT order_key, file_name, weather_file,
           CAST(nullif(regexp_extract(file_name, '(20\\d{2})', 1), '') AS INTEGER) AS file_year,
           CAST(nullif(regexp_extract(file_name, '^(\\d{2})[._]', 1), '') AS INTEGER) AS file_month,
           nullif(regexp_extract(weather_file, '^(.+?)_\\d{8}_\\d{8}', 1), '') AS location_code
    FROM (SELECT order_key,
                 printf('%02d.%s-Definitivo-%d.xls', month(day), strftime(day, '%b'), year(day)) AS file_name,
                 lower(replace(entity, '_', '')) || '_' || strftime(day, '%Y%m%d') || '_' ||
                 strftime(day + INTERVAL 30 DAY, '%Y%m%d') || '_20240101T000000Z.json' AS weather_file
          FROM daily)""", "daily"))
def filename_fields(spark, sf):
    d = P.daily(spark, sf)
    named = d.select(
        "order_key",
        F.format_string("%02d.%s-Definitivo-%d.xls", F.month("day"), F.date_format("day", "MMM"),
                        F.year("day")).alias("file_name"),
        F.concat(F.lower(F.regexp_replace("entity", "_", "")), F.lit("_"),
                 D.range_stem(F.col("day"), F.date_add("day", 30)),
                 F.lit("_20240101T000000Z.json")).alias("weather_file"))
    return S.with_file_fields(named, "file_name").withColumn("location_code", S.location_code("weather_file"))


@register("source_inventory", """
    WITH f AS (SELECT source, 'doc_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.txt' AS name,
                      strlen(text) AS bytes FROM documents)
    SELECT source, count(*) AS files, round(sum(bytes) / 1024.0 / 1024.0, 2) AS size_mb,
           (SELECT string_agg(name, ', ' ORDER BY name) FROM
              (SELECT name FROM f f2 WHERE f2.source = f.source ORDER BY name LIMIT 3)) AS examples
    FROM f GROUP BY source""")
def source_inventory(spark, sf):
    d = table(spark, sf, "documents").select(
        "source", F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".txt")).alias("name"),
        F.octet_length("text").alias("bytes"))
    return S.inventory_summary(d, "source", "bytes", "name", k=3)


@register("request_plan", with_blocks("""
    SELECT entity, year_month,
           'https://api.example.org/v1/daily?' || concat_ws('&',
              'location=' || url_encode(lower(entity)),
              'from=' || url_encode(replace(year_month, '-', '') || '01'),
              'to=' || url_encode(strftime(last_day(CAST(year_month || '-01' AS DATE)), '%Y%m%d')),
              CASE WHEN price_n_avg IS NOT NULL THEN 'open=' || url_encode('1') END) AS url,
           lower(entity) || '_' || replace(year_month, '-', '') || '01_' ||
              strftime(last_day(CAST(year_month || '-01' AS DATE)), '%Y%m%d') AS file_stem
    FROM monthly""", "monthly"))
def request_plan(spark, sf):
    """S11/F-D4: one request URL and file stem per (entity, month) to fetch."""
    m = P.silver_monthly(spark, sf)
    start = D.month_start("year_month")
    end = F.last_day(start)
    params = [("location", F.lower("entity")),
              ("from", F.date_format(start, "yyyyMMdd")),
              ("to", F.date_format(end, "yyyyMMdd")),
              ("open", F.when(F.col("price_n_avg").isNotNull(), F.lit("1")))]
    return m.select("entity", "year_month",
                    S.request_url("https://api.example.org/v1/daily", params).alias("url"),
                    F.concat(F.lower("entity"), F.lit("_"), D.range_stem(start, end)).alias("file_stem"))


@register("year_month_format", """
    SELECT o_orderkey, printf('%04d-%02d', year(o_orderdate), month(o_orderdate)) AS year_month FROM orders""")
def year_month_format(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.year_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("year_month"))


@register("calendar_enrichment", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month, strftime(o_orderdate, '%Y-%m') AS year_month,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, isodow(o_orderdate) >= 6 AS is_weekend
    FROM orders""")
def calendar_enrichment(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return D.calendar_columns(o, "date")


@register("date_decomposition", with_blocks("""
    SELECT entity, year_month, CAST(year_month || '-01' AS DATE) AS date,
           CAST(substring(year_month, 1, 4) AS INTEGER) AS year, CAST(substring(year_month, 6, 2) AS INTEGER) AS month,
           CAST(quarter(CAST(year_month || '-01' AS DATE)) AS INTEGER) AS quarter,
           CAST(CAST(substring(year_month, 6, 2) AS INTEGER) IN (6, 7, 8, 9) AS INTEGER) AS is_high_season
    FROM monthly""", "monthly"))
def date_decomposition(spark, sf):
    m = P.silver_monthly(spark, sf).select("entity", "year_month")
    return D.date_parts(m, "year_month")


@register("clean_number", """
    SELECT c_custkey, round(c_acctbal, 4) AS acctbal_clean,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE round(sqrt(c_acctbal), 4) END AS acctbal_sqrt_clean
    FROM customer""")
def clean_number(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", N.clean_number("c_acctbal").alias("acctbal_clean"),
                    N.clean_number(F.sqrt("c_acctbal")).alias("acctbal_sqrt_clean"))


@register("truncating_cast", """
    SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS acctbal_int,
           CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(trunc(sqrt(c_acctbal) * 10) AS BIGINT) END AS sqrt10_int
    FROM customer""")
def truncating_cast(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", N.truncating_cast("c_acctbal").alias("acctbal_int"),
                    N.truncating_cast(F.sqrt("c_acctbal") * 10).alias("sqrt10_int"))


@register("numeric_transforms", """
    SELECT c_custkey,
           round(ln(1 + CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END), 6) AS acctbal_log1p,
           round(sqrt(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END), 6) AS acctbal_sqrt,
           round(c_acctbal * c_acctbal, 4) AS acctbal_sq
    FROM customer""")
def numeric_transforms(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", rnd(N.log1p_clipped("c_acctbal"), 6).alias("acctbal_log1p"),
                    rnd(N.sqrt_clipped("c_acctbal"), 6).alias("acctbal_sqrt"),
                    rnd(F.pow("c_acctbal", 2), 4).alias("acctbal_sq"))


@register("json_field_default", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           coalesce(json_extract_string(props, '$.missing'), 'none') AS missing_default
    FROM events""")
def json_field_default(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                    F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing_default"))


@register("numeric_coercion", """
    SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_text,
           TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_text,
           event_type AS type_text,
           lower(trim(CASE WHEN event_type = 'purchase' THEN ' Yes ' WHEN event_type = 'error' THEN '1'
                           ELSE 'no' END)) IN ('true', '1', 'yes') AS flag
    FROM events""")
def numeric_coercion(spark, sf):
    e = table(spark, sf, "events")
    raw = e.select("event_id", F.col("value").cast("string").alias("value_text"),
                   F.get_json_object("props", "$.k").alias("k_text"),
                   F.col("event_type").alias("type_text"),
                   F.when(F.col("event_type") == "purchase", F.lit(" Yes "))
                    .when(F.col("event_type") == "error", F.lit("1")).otherwise(F.lit("no")).alias("flag"))
    return S.coerce_numeric(raw, exempt=["event_id"], boolean_cols=["flag"])


@register("parallel_array_explode", """
    SELECT vec_id, time, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM (
      SELECT vec_id, CAST(i AS INTEGER) AS time, embedding[i + 1] AS a,
             CASE WHEN i < 8 + label * 4 THEN embedding[i + 1] END AS b
      FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS i FROM embeddings))""")
def parallel_array_explode(spark, sf):
    """S1/F-A1: aligned arrays of unequal length exploded by the time array's
    positions, one per element of the embedding; a shorter array pads with NULL."""
    e = table(spark, sf, "embeddings")
    emb = F.transform("embedding", lambda x: x.cast("double"))
    doc = e.select("vec_id", F.struct(
        F.transform("embedding", lambda x, i: i).alias("time"),
        emb.alias("a"),
        F.slice(emb, 1, F.lit(8) + F.col("label") * 4).alias("b")).alias("daily"))
    return S.explode_parallel_arrays(doc, "daily", "time", ["a", "b"], keep=["vec_id"])
