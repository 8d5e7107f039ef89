"""Shared SQL blocks for the DuckDB oracle (same semantics as ``panel.py``).

``with_blocks(body, *names)`` prepends the named blocks, and whatever they
depend on, as CTEs in dependency order.
"""

from __future__ import annotations

def sql_cent_avg(x: str) -> str:
    """Aggregate: the mean of non-negative amounts in cents, to 4 decimals, half up.

    In whole numbers: averages over 8 or 16 rows often lie exactly between two
    decimals, where rounding a double depends on the engine.
    """
    cents = f"CAST(sum(CAST({x} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return f"CAST((200 * {cents} + count({x})) // (2 * count({x})) AS DOUBLE) / 10000"


# name -> (dependencies, SQL)
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "entity_dim": ((), """
        SELECT n.n_nationkey AS nationkey, n.n_name AS entity, r.r_name AS region
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "daily": (("entity_dim",), """
        SELECT d.entity, d.region, o.o_orderkey AS order_key,
               CAST(o.o_orderdate AS DATE) AS day,
               strftime(o.o_orderdate, '%Y-%m') AS year_month,
               o.o_orderpriority AS priority, o.o_orderstatus AS status,
               o.o_totalprice AS price,
               CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice END AS price_n
        FROM orders o
        JOIN (SELECT c.c_custkey, d.* FROM customer c
              LEFT JOIN entity_dim d ON c.c_nationkey = d.nationkey) d
          ON o.o_custkey = d.c_custkey"""),
    "monthly": (("daily",), """
        SELECT entity, year_month, count(*) AS days,
               """ + sql_cent_avg("price") + """ AS price_avg,
               """ + sql_cent_avg("price_n") + """ AS price_n_avg,
               round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE), 4) AS price_total,
               round(CAST(sum(CAST(price_n AS DECIMAL(18,2))) AS DOUBLE), 4) AS price_n_total
        FROM daily GROUP BY entity, year_month"""),
    "calendar": (("daily",), """
        SELECT day, year_month, order_key, priority,
               CASE WHEN priority = '1-URGENT' THEN 'national'
                    WHEN priority = '2-HIGH' THEN 'regional' ELSE 'local' END AS scope,
               CASE WHEN priority = '1-URGENT' THEN 'ALL' ELSE region END AS region_code
        FROM daily"""),
    "cal_counts": (("calendar",), """
        SELECT year_month, region_code, count(*) AS n
        FROM calendar WHERE scope IN ('national', 'regional')
        GROUP BY year_month, region_code"""),
    "sup_month": (("entity_dim",), """
        SELECT p.l_suppkey AS supplier_key, d.entity, p.year_month, p.ship_qty, p.ship_lines, p.ship_value
        FROM (SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS year_month,
                     CAST(trunc(sum(l_quantity)) AS BIGINT) AS ship_qty,
                     count(*) AS ship_lines,
                     CAST(trunc(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)) AS BIGINT) AS ship_value
              FROM lineitem GROUP BY l_suppkey, strftime(l_shipdate, '%Y-%m')) p
        JOIN (SELECT s.s_suppkey, d.entity FROM supplier s
              LEFT JOIN entity_dim d ON s.s_nationkey = d.nationkey) d
          ON p.l_suppkey = d.s_suppkey"""),
    "sup_rollup": (("sup_month",), """
        SELECT entity, year_month,
               CAST(sum(ship_qty) AS BIGINT) AS ship_qty,
               CAST(sum(ship_lines) AS BIGINT) AS ship_lines,
               CAST(sum(ship_value) AS BIGINT) AS ship_value,
               count(*) AS supplier_count
        FROM sup_month GROUP BY entity, year_month"""),
    "target": (("entity_dim",), """
        SELECT d.entity, strftime(o.o_orderdate, '%Y-%m') AS year_month,
               CAST(count(*) AS DOUBLE) AS target_lines,
               sum(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity END) AS target_qty,
               """ + sql_cent_avg("l.l_quantity") + """ AS target_avg_qty,
               """ + sql_cent_avg("l.l_discount") + """ AS target_discount_avg
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN (SELECT c.c_custkey, d.entity FROM customer c
              LEFT JOIN entity_dim d ON c.c_nationkey = d.nationkey) d
          ON o.o_custkey = d.c_custkey
        WHERE o.o_orderpriority = '1-URGENT'
        GROUP BY d.entity, strftime(o.o_orderdate, '%Y-%m')"""),
    "panel": (("monthly", "cal_counts", "sup_rollup", "target"), """
        SELECT m.entity, m.year_month, m.days, m.price_avg, m.price_n_avg, m.price_total, m.price_n_total,
               e.region AS region_code,
               coalesce(na.n, 0) AS national_count,
               coalesce(re.n, 0) AS regional_count,
               coalesce(na.n, 0) + coalesce(re.n, 0) AS total_count,
               coalesce(s.ship_qty, 0) AS ship_qty,
               coalesce(s.ship_lines, 0) AS ship_lines,
               coalesce(s.ship_value, 0) AS ship_value,
               coalesce(s.supplier_count, 0) AS supplier_count,
               t.target_lines, t.target_qty, t.target_avg_qty, t.target_discount_avg,
               t.target_qty IS NOT NULL AS target_available,
               'orders_monthly+priority_calendar+supplier_shipments+urgent_returns' AS feature_source
        FROM monthly m
        LEFT JOIN (SELECT DISTINCT entity, region FROM entity_dim) e ON m.entity = e.entity
        LEFT JOIN cal_counts na ON na.year_month = m.year_month AND na.region_code = 'ALL'
        LEFT JOIN cal_counts re ON re.year_month = m.year_month AND re.region_code = e.region
                                 AND re.region_code <> 'ALL'
        LEFT JOIN sup_rollup s ON s.entity = m.entity AND s.year_month = m.year_month
        LEFT JOIN target t ON t.entity = m.entity AND t.year_month = m.year_month"""),
}


def sql_sorted_list(x: str) -> str:
    """Aggregate: the non-NULL values of ``x`` as a sorted list."""
    return f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))"


def sql_quantile(v: str, p: float) -> str:
    """Exact linear-interpolated quantile of a sorted list ``v`` with the
    same double arithmetic as Spark's ``percentile``:
    ``pos = (n-1)*p``; ``(ceil(pos)-pos)*lo + (pos-floor(pos))*hi``."""
    pos = f"(CAST(len({v}) - 1 AS DOUBLE) * CAST({p!r} AS DOUBLE))"
    lo = f"{v}[CAST(floor({pos}) AS BIGINT) + 1]"
    hi = f"{v}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return (f"(CASE WHEN floor({pos}) = ceil({pos}) OR {lo} = {hi} THEN CAST({lo} AS DOUBLE) "
            f"ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END)")


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in BLOCKS[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_blocks(body: str, *names: str) -> str:
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n][1]}\n)" for n in _order(names))
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        # Merge the body's own CTE list into ours.
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def sql_normalize(expr: str) -> str:
    """DuckDB form of ``normalize_text`` for Latin text (strip_accents folds
    the accents; ``ß`` is expanded first because DuckDB upper-cases it to
    ``ẞ``)."""
    return ("coalesce(trim(regexp_replace(regexp_replace(upper(strip_accents(replace("
            f"CAST({expr} AS VARCHAR), 'ß', 'ss'))), '[^\\x00-\\x7F]', '', 'g'), "
            "'[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f ]+', ' ', 'g')), '')")


def sql_bucket(x: str, edges: list[float], labels: list[str]) -> str:
    """SQL form of ``functions.numeric.bucket`` (right-closed, NULL outside)."""
    import math
    parts = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = [f"{x} IS NOT NULL", f"NOT isnan({x})"]
        if lo != -math.inf:
            cond.append(f"{x} > {lo!r}")
        if hi != math.inf:
            cond.append(f"{x} <= {hi!r}")
        parts.append(f"WHEN {' AND '.join(cond)} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


PRICE_EDGES = [float("-inf"), 200000.0, 250000.0, 300000.0, float("inf")]
PRICE_LABELS = ["low", "mid", "high", "top"]
DISCOUNT_EDGES = [-0.001, 0.03, 0.06, float("inf")]
DISCOUNT_LABELS = ["small", "medium", "large"]
SEGMENT_LABELS = ["low", "medium", "high", "very_high"]

BLOCKS["model"] = (("panel",), f"""
    SELECT p.*, CAST(p.year_month || '-01' AS DATE) AS date,
           CAST(substring(p.year_month, 1, 4) AS INTEGER) AS year,
           CAST(substring(p.year_month, 6, 2) AS INTEGER) AS month,
           CAST(quarter(CAST(p.year_month || '-01' AS DATE)) AS INTEGER) AS quarter,
           CAST(CAST(substring(p.year_month, 6, 2) AS INTEGER) IN (6, 7, 8, 9) AS INTEGER) AS is_high_season,
           ln(1 + p.target_qty) AS target_qty_log1p,
           ln(1 + CASE WHEN p.ship_qty < 0 THEN 0 ELSE p.ship_qty END) AS ship_qty_log1p,
           sqrt(CASE WHEN p.target_discount_avg < 0 THEN 0 ELSE p.target_discount_avg END) AS discount_sqrt,
           p.price_avg * p.price_avg AS price_avg_sq,
           {sql_bucket('p.price_avg', PRICE_EDGES, PRICE_LABELS)} AS price_bucket,
           {sql_bucket('p.price_n_avg', PRICE_EDGES, PRICE_LABELS)} AS price_n_bucket,
           {sql_bucket('p.target_discount_avg', DISCOUNT_EDGES, DISCOUNT_LABELS)} AS discount_bucket
    FROM panel p WHERE p.target_qty IS NOT NULL""")
BLOCKS["model_months"] = (("model",), """
    SELECT year_month, row_number() OVER (ORDER BY year_month) AS month_pos
    FROM (SELECT DISTINCT year_month FROM model)""")
BLOCKS["split"] = (("model_months",), """
    SELECT m.*, CASE WHEN mm.month_pos <= (SELECT floor(count(*) * 0.8) FROM model_months)
                     THEN 'train' ELSE 'test' END AS split
    FROM model m JOIN model_months mm ON m.year_month = mm.year_month""")

BLOCKS["monthly_idx"] = (("monthly",), """
    SELECT *, CAST(substring(year_month, 1, 4) AS INTEGER) * 12 + CAST(substring(year_month, 6, 2) AS INTEGER) - 1
              AS month_idx
    FROM monthly""")
