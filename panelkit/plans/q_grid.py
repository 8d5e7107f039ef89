"""Cell-grid queries (G1-G4): supplier-month shipments rendered as one
workbook per ship month (a decoy notes sheet, then a data sheet with three
metric blocks in different row orders and spellings), then parsed back.

The rendering is deterministic and grows with the shipments; the parse is
the library's G1-G4. Parsing must give back the supplier-month metrics.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.text import title_case
from panelkit.operators import grid as G
from panelkit.plans import panel as P
from panelkit.plans.oracle_blocks import BLOCKS, sql_normalize, with_blocks
from panelkit.plans.q_text import _sql_entity_name
from panelkit.plans.registry import register
from panelkit.plans.tables import table
from panelkit.session import materialize

# Fixed layout of the rendered workbook: (row, col, text) of the static cells.
NOTES_SHEET = [(0, 0, "Pasajeros, operaciones y mercancía"), (1, 0, "Sin datos"), (2, 0, "Fin")]
DATA_SHEET_HEAD = [
    (0, 0, "Tráfico mensual de proveedores"),
    (1, 0, "Pasajeros"), (1, 3, "Operaciones"), (1, 6, "Mercancía (kg)"),
    (2, 0, "Aeropuertos"), (2, 1, "Total"), (2, 2, "Total"), (2, 3, "Aeropuertos"), (2, 4, "Total"),
    (2, 6, "Aeropuertos"), (2, 7, "% Var."), (2, 8, "Total"),
    (3, 1, "Año actual"),
]


# Block 2 lists suppliers in descending key order from this row down; the
# TOTAL row sits below every data row. Row numbers are 64-bit: any key from 0
# to 2^61 lies between the header and the TOTAL row in every block.
REVERSE_BASE = 2 ** 61 + 4
TOTAL_ROW = 2 ** 62


def render_cells(spark, sf):
    """The rendered workbooks as a stored cell table (materialized once)."""
    from panelkit.plans.tables import shared_table
    return shared_table(spark, sf, "cells", lambda: _render_cells(spark, sf))


def _render_cells(spark, sf):
    sm = P.supplier_months(spark, sf)
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier_key"), "s_name")
    data = (sm.join(s, "supplier_key")
              .withColumn("source_file", F.concat(F.lit("traffic_"), "year_month", F.lit(".xlsx"))))
    digits = F.element_at(F.split("s_name", "#"), -1)
    key = F.col("supplier_key").cast("bigint")
    cell = lambda r, c, v: F.struct(r.cast("bigint").alias("row"), F.lit(c).alias("col"), v.cast("string").alias("value"))
    body = data.select("source_file", F.inline(F.array(
        cell(F.lit(4) + key, 0, F.concat(F.lit("Supplier - "), digits)),
        cell(F.lit(4) + key, 1, F.col("ship_qty")),
        cell(F.lit(REVERSE_BASE) - key, 3, F.concat(F.lit("supplier/"), digits, F.lit(" (**)"))),
        cell(F.lit(REVERSE_BASE) - key, 4, F.col("ship_lines")),
        cell(F.lit(4) + key, 6, F.concat(F.lit("SUPPLIER  -  "), digits)),
        cell(F.lit(4) + key, 8, F.when(F.col("ship_value") != 0, F.col("ship_value"))),
    )))
    totals = data.groupBy("source_file").agg(
        F.sum("ship_qty").alias("q"), F.sum("ship_lines").alias("l"), F.sum("ship_value").alias("v"))
    trow = F.lit(TOTAL_ROW)
    total_cells = totals.select("source_file", F.inline(F.array(
        cell(trow, 0, F.lit("Total general")), cell(trow, 1, F.col("q")),
        cell(trow, 3, F.lit("TOTAL")), cell(trow, 4, F.col("l")),
        cell(trow, 6, F.lit("Total")), cell(trow, 8, F.col("v")))))
    files = data.select("source_file").distinct()
    head = files.select("source_file", F.inline(F.array(
        *[cell(F.lit(r), c, F.lit(t)) for r, c, t in DATA_SHEET_HEAD])))
    data_sheet = (body.unionByName(total_cells).unionByName(head)
                  .withColumns({"sheet_name": F.lit("Datos"), "sheet_index": F.lit(1)}))
    notes = files.select("source_file", F.inline(F.array(
        *[cell(F.lit(r), c, F.lit(t)) for r, c, t in NOTES_SHEET])))
    notes = notes.withColumns({"sheet_name": F.lit("Notas"), "sheet_index": F.lit(0)})
    return data_sheet.unionByName(notes).select(
        "source_file", "sheet_name", F.col("sheet_index").cast("int"), F.col("row").cast("bigint"),
        F.col("col").cast("int"), "value")


def _sql_cells() -> str:
    def lit(rows, sheet, idx):
        vals = ", ".join(f"({r}, {c}, '{t}')" for r, c, t in rows)
        return (f"SELECT f.source_file, '{sheet}' AS sheet_name, {idx} AS sheet_index, v.r AS row, v.c AS col, "
                f"v.t AS value FROM files f, (VALUES {vals}) v(r, c, t)")
    return f"""
    WITH sm AS (SELECT m.*, s.s_name, 'traffic_' || m.year_month || '.xlsx' AS source_file,
                       CAST(m.supplier_key AS BIGINT) AS k, split_part(s.s_name, '#', -1) AS digits
                FROM sup_month m JOIN supplier s ON m.supplier_key = s.s_suppkey),
    files AS (SELECT DISTINCT source_file FROM sm),
    body AS (
      SELECT source_file, 4 + k AS row, 0 AS col, 'Supplier - ' || digits AS value FROM sm
      UNION ALL SELECT source_file, 4 + k, 1, CAST(ship_qty AS VARCHAR) FROM sm
      UNION ALL SELECT source_file, {REVERSE_BASE} - k, 3, 'supplier/' || digits || ' (**)' FROM sm
      UNION ALL SELECT source_file, {REVERSE_BASE} - k, 4, CAST(ship_lines AS VARCHAR) FROM sm
      UNION ALL SELECT source_file, 4 + k, 6, 'SUPPLIER  -  ' || digits FROM sm
      UNION ALL SELECT source_file, 4 + k, 8, CASE WHEN ship_value <> 0 THEN CAST(ship_value AS VARCHAR) END FROM sm
      UNION ALL SELECT source_file, {TOTAL_ROW}, 0, 'Total general' FROM sm GROUP BY source_file
      UNION ALL SELECT source_file, {TOTAL_ROW}, 1, CAST(sum(ship_qty) AS VARCHAR) FROM sm GROUP BY source_file
      UNION ALL SELECT source_file, {TOTAL_ROW}, 3, 'TOTAL' FROM sm GROUP BY source_file
      UNION ALL SELECT source_file, {TOTAL_ROW}, 4, CAST(sum(ship_lines) AS VARCHAR) FROM sm GROUP BY source_file
      UNION ALL SELECT source_file, {TOTAL_ROW}, 6, 'Total' FROM sm GROUP BY source_file
      UNION ALL SELECT source_file, {TOTAL_ROW}, 8, CAST(sum(ship_value) AS VARCHAR) FROM sm GROUP BY source_file)
    SELECT source_file, 'Datos' AS sheet_name, 1 AS sheet_index, CAST(row AS BIGINT) AS row,
           CAST(col AS INTEGER) AS col, value FROM body
    UNION ALL {lit(DATA_SHEET_HEAD, 'Datos', 1)}
    UNION ALL {lit(NOTES_SHEET, 'Notas', 0)}"""


BLOCKS["cells"] = (("sup_month",), _sql_cells().replace("WITH sm AS", "SELECT * FROM (WITH sm AS", 1) + ")")
BLOCKS["row_text"] = (("cells",), f"""
    SELECT source_file, sheet_name, sheet_index, row, string_agg({sql_normalize('value')}, ' ' ORDER BY col) AS text
    FROM cells WHERE row <= 20 GROUP BY source_file, sheet_name, sheet_index, row""")
BLOCKS["titles"] = (("row_text",), """
    SELECT source_file, sheet_name, sheet_index, title_row FROM (
      SELECT r.source_file, r.sheet_name, r.sheet_index, r.row AS title_row,
             row_number() OVER (PARTITION BY r.source_file ORDER BY r.sheet_index, r.row) AS rn
      FROM row_text r
      JOIN row_text nx ON nx.source_file = r.source_file AND nx.sheet_index = r.sheet_index AND nx.row = r.row + 1
      JOIN (SELECT source_file, sheet_index, max(row) + 1 AS n FROM cells GROUP BY ALL) n
        ON n.source_file = r.source_file AND n.sheet_index = r.sheet_index
      WHERE r.row < least(20, n.n - 2) AND contains(r.text, 'PASAJEROS') AND contains(r.text, 'OPERACIONES')
        AND contains(r.text, 'MERCANCIA') AND contains(nx.text, 'AEROPUERTOS') AND contains(nx.text, 'TOTAL'))
    WHERE rn = 1""")
BLOCKS["pairs"] = (("titles",), f"""
    SELECT source_file, sheet_index, title_row, block,
           ['passengers', 'operations', 'cargo_kg'][block] AS metric, name_col, total_col FROM (
      SELECT h.source_file, h.sheet_index, h.title_row, h.col AS name_col,
             CAST(row_number() OVER (PARTITION BY h.source_file ORDER BY h.col) AS INTEGER) AS block,
             (SELECT min(t.col) FROM cells t WHERE t.source_file = h.source_file AND t.sheet_index = h.sheet_index
                AND t.row = h.title_row + 1 AND {sql_normalize('t.value')} = 'TOTAL' AND t.col > h.col) AS total_col
      FROM (SELECT c.*, ti.title_row FROM cells c JOIN titles ti ON c.source_file = ti.source_file
              AND c.sheet_index = ti.sheet_index AND c.row = ti.title_row + 1) h
      WHERE contains({sql_normalize('h.value')}, 'AEROPUERTOS'))
    WHERE total_col IS NOT NULL""")
BLOCKS["blocks"] = (("pairs",), f"""
    SELECT source_file, metric, entity_name, arg_max(value, row) AS value FROM (
      SELECT n.source_file, p.metric, n.row, {_sql_entity_name('n.value')} AS entity_name,
             CAST(trunc(coalesce(TRY_CAST(v.value AS DOUBLE), 0)) AS BIGINT) AS value
      FROM cells n
      JOIN pairs p ON n.source_file = p.source_file AND n.sheet_index = p.sheet_index AND n.col = p.name_col
      JOIN (SELECT c.source_file, p2.block, min(c.row) AS end_row FROM cells c
            JOIN pairs p2 ON c.source_file = p2.source_file AND c.sheet_index = p2.sheet_index AND c.col = p2.name_col
            WHERE c.row >= p2.title_row + 3 AND starts_with({sql_normalize('c.value')}, 'TOTAL')
            GROUP BY c.source_file, p2.block) e ON e.source_file = n.source_file AND e.block = p.block
      LEFT JOIN cells v ON v.source_file = n.source_file AND v.sheet_index = n.sheet_index AND v.row = n.row
                       AND v.col = p.total_col
      WHERE n.row >= p.title_row + 3 AND n.row < e.end_row)
    WHERE entity_name <> '' GROUP BY source_file, metric, entity_name""")


@register("grid_title_row", with_blocks("SELECT * FROM titles", "titles"))
def grid_title_row(spark, sf):
    return G.find_title_rows(render_cells(spark, sf))


@register("grid_block_pairs", with_blocks(
    "SELECT source_file, block, metric, name_col, total_col FROM pairs", "pairs"))
def grid_block_pairs(spark, sf):
    cells = render_cells(spark, sf)
    return G.pair_blocks(cells, materialize(G.find_title_rows(cells))).select(
        "source_file", "block", "metric", "name_col", "total_col")


@register("grid_block_extract", with_blocks("SELECT * FROM blocks", "blocks"))
def grid_block_extract(spark, sf):
    cells = render_cells(spark, sf)
    titles = materialize(G.find_title_rows(cells))
    return G.extract_blocks(cells, materialize(G.pair_blocks(cells, titles)))


@register("grid_tidy_table", with_blocks(f"""
    SELECT source_file, regexp_extract(source_file, 'traffic_(\\d{{4}}-\\d{{2}})', 1) AS year_month,
           entity_name,
           array_to_string(list_transform(regexp_extract_all(entity_name, '(\\pL+|\\PL+)'),
                                          lambda r: upper(r[1]) || lower(r[2:])), '') AS display_name,
           CAST(coalesce(max(value) FILTER (WHERE metric = 'passengers'), 0) AS BIGINT) AS passengers,
           CAST(coalesce(max(value) FILTER (WHERE metric = 'operations'), 0) AS BIGINT) AS operations,
           CAST(coalesce(max(value) FILTER (WHERE metric = 'cargo_kg'), 0) AS BIGINT) AS cargo_kg
    FROM blocks GROUP BY source_file, entity_name""", "blocks"))
def grid_tidy_table(spark, sf):
    t = G.tidy_table(render_cells(spark, sf))
    return t.select("source_file", F.regexp_extract("source_file", r"traffic_(\d{4}-\d{2})", 1).alias("year_month"),
                    "entity_name", title_case("entity_name").alias("display_name"), *G.METRICS)
