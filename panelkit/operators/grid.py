"""Multi-block sheet -> tidy table (G1-G4) on a long cell table.

Input contract: ``cells(source_file, sheet_name, sheet_index, row, col,
value)`` with 0-based ``row``/``col`` and the cell text (NULL for blank).
Decoding the workbook container into cells is per-file work outside this
module; everything here is joins and aggregates keyed by file, so the work
spreads over files and rows instead of one file per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.text import entity_key, normalize_text
from panelkit.operators.joins import bounded_broadcast, next_match
from panelkit.session import stored

# Fixed values of the airport-statistics layout.
TITLE_TERMS = ["PASAJEROS", "OPERACIONES", "MERCANCIA"]
HEADER_TERMS = ["AEROPUERTOS", "TOTAL"]
NAME_HEADER = "AEROPUERTOS"
TOTAL_HEADER = "TOTAL"
METRICS = ["passengers", "operations", "cargo_kg"]
FILE = ["source_file"]


def _fail_if_any(df: DataFrame, message: str) -> None:
    if df.limit(1).count() > 0:
        sample = [tuple(r) for r in df.limit(5).collect()]
        raise ValueError(f"{message}: {sample}")


def row_texts(cells: DataFrame, max_row: int) -> DataFrame:
    """Normalized text of each row (cells joined by spaces in column order),
    for rows ``<= max_row`` only; a row holds few cells, so gathering them
    is bounded."""
    c = cells.where(F.col("row") <= max_row).select(
        "source_file", "sheet_name", "sheet_index", "row", "col", normalize_text("value").alias("norm"))
    return c.groupBy("source_file", "sheet_name", "sheet_index", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "norm"))),
                                 lambda x: x["norm"]), " ").alias("text"))


def sheet_heads(cells: DataFrame, max_rows: int = 20) -> DataFrame:
    """Per sheet its number of rows and its cells in rows ``0..max_rows``: all that finding the layout reads."""
    head = F.when(F.col("row") <= max_rows, F.struct("row", "col", "value"))
    return cells.groupBy("source_file", "sheet_name", "sheet_index").agg(
        (F.max("row") + 1).alias("n_rows"), F.collect_list(head).alias("head"))


def head_cells(heads: DataFrame) -> DataFrame:
    """The cell rows of :func:`sheet_heads`."""
    return heads.select("source_file", "sheet_name", "sheet_index", F.inline("head"))


def find_title_rows(cells: DataFrame, title_terms: list[str] = TITLE_TERMS,
                    header_terms: list[str] = HEADER_TERMS, max_rows: int = 20,
                    strict: bool = True, heads: DataFrame | None = None) -> DataFrame:
    """G1: per file, the first sheet (by ``sheet_index``) and first row whose
    text contains every title term while the next row contains every header
    term, searching rows ``< min(max_rows, n_rows - 2)``. A file without such
    a row fails the job when ``strict``, and has no title row otherwise.
    ``heads`` (:func:`sheet_heads`, with at least ``max_rows``) spares the scan of the cells."""
    heads = sheet_heads(cells, max_rows) if heads is None else heads
    texts = row_texts(head_cells(heads), max_rows)
    nxt = texts.select("source_file", "sheet_index", (F.col("row") - 1).alias("row"),
                       F.col("text").alias("next_text"))
    cond = F.col("row") < F.least(F.lit(max_rows), F.col("n_rows") - 2)
    for t in title_terms:
        cond = cond & F.col("text").contains(t)
    for t in header_terms:
        cond = cond & F.col("next_text").contains(t)
    cand = (texts.join(nxt, ["source_file", "sheet_index", "row"])
                 .join(heads.select("source_file", "sheet_index", "n_rows"), ["source_file", "sheet_index"]).where(cond))
    first = cand.groupBy("source_file").agg(
        F.min(F.struct("sheet_index", "row", "sheet_name")).alias("t"))
    titles = first.select("source_file", F.col("t.sheet_name").alias("sheet_name"),
                          F.col("t.sheet_index").alias("sheet_index"), F.col("t.row").alias("title_row"))
    if strict:
        missing = heads.select("source_file").distinct().join(titles, "source_file", "left_anti")
        _fail_if_any(missing, "no data table found in")
    return titles


def pair_blocks(cells: DataFrame, titles: DataFrame, expected: int = 3, metrics: list[str] = METRICS,
                strict: bool = True) -> DataFrame:
    """On the header row (title + 1), pair each name column with the next
    TOTAL column to its right; name columns are numbered left to right and
    mapped onto ``metrics``. Layout errors (not exactly ``expected`` name
    columns, fewer TOTAL columns, or a name column without a TOTAL after it)
    fail the job when ``strict``; otherwise such files are dropped."""
    header_rows = titles.select("source_file", "sheet_index", "title_row", (F.col("title_row") + 1).alias("row"))
    head = cells.join(header_rows, ["source_file", "sheet_index", "row"])
    norm = normalize_text("value")
    head = head.select("source_file", "sheet_index", "title_row", "col",
                       norm.contains(NAME_HEADER).alias("is_name"), (norm == TOTAL_HEADER).alias("is_total"))
    head = next_match(head, FILE, "col", F.col("is_total"), "total_col", hot_rows=None)  # one header row
    names = head.where("is_name")
    counts = head.groupBy("source_file").agg(F.count_if("is_name").alias("n_names"),
                                              F.count_if("is_total").alias("n_totals"))
    ok = (F.col("n_names") == expected) & (F.col("n_totals") >= expected)
    if strict:
        _fail_if_any(counts.where(~ok), "unexpected header layout")
        _fail_if_any(names.where(F.col("total_col").isNull()), "no total column after name column")
    good = counts.where(ok).select("source_file")
    from pyspark.sql import Window
    w = Window.partitionBy("source_file").orderBy("col")
    pairs = (names.join(good, "source_file", "left_semi").where(F.col("total_col").isNotNull())
                  .withColumn("block", F.row_number().over(w)))
    metric = F.element_at(F.array(*[F.lit(m) for m in metrics]), F.col("block"))
    return pairs.select("source_file", "sheet_index", "title_row", "block", metric.alias("metric"),
                        F.col("col").alias("name_col"), "total_col")


def block_rows(cells: DataFrame, pairs: DataFrame, strict: bool = True) -> DataFrame:
    """The named rows of every block: (source_file, metric, row, entity_name, value).

    Only the cells of name and total columns are kept, by an equi-join with
    the block layout (two rows per block; broadcast after a check of its size,
    shuffled beyond it), and the two cells of a row and block are paired. The
    paired rows are stored, since the blocks' ends come from them first.
    """
    wanted = pairs.select("source_file", "sheet_index", "title_row", "block", "metric", F.inline(F.array(
        F.struct(F.col("name_col").alias("col"), F.lit(True).alias("is_name")),
        F.struct(F.col("total_col").alias("col"), F.lit(False).alias("is_name")))))
    staged = (cells.join(bounded_broadcast(wanted), ["source_file", "sheet_index", "col"])
                   .where(F.col("row") >= F.col("title_row") + 3)
                   .groupBy("source_file", "block", "metric", "row")
                   .agg(F.max(F.when(F.col("is_name"), F.col("value"))).alias("name"),
                        F.max(F.when(~F.col("is_name"), F.col("value"))).alias("raw"))
                   .withColumn("__norm", normalize_text("name")))
    staged = stored(staged, "block-rows")
    ends = (staged.where(F.col("__norm").startswith("TOTAL"))
                  .groupBy("source_file", "block").agg(F.min("row").alias("end_row")))
    if strict:
        _fail_if_any(pairs.join(ends, ["source_file", "block"], "left_anti"), "no total row in block")
    value = F.coalesce(F.nanvl(F.col("raw").cast("double"), F.lit(None).cast("double")), F.lit(0.0)).cast("bigint")
    return (staged.join(ends, ["source_file", "block"]).where(F.col("row") < F.col("end_row"))
                  .select("source_file", "metric", "row", entity_key("__norm").alias("entity_name"),
                          value.alias("value"))
                  .where(F.col("entity_name") != ""))


def extract_blocks(cells: DataFrame, pairs: DataFrame, strict: bool = True) -> DataFrame:
    """Rows ``title+3`` up to the first row whose name starts with TOTAL;
    blank names skipped; value NULL -> 0, truncated to bigint; a repeated
    name keeps its last row. Blocks without a TOTAL row fail when ``strict``
    and are dropped otherwise."""
    return block_rows(cells, pairs, strict).groupBy("source_file", "metric", "entity_name").agg(
        F.max_by("value", "row").alias("value"))


def pivot_blocks(blocks: DataFrame, metrics: list[str] = METRICS, fill: int = 0) -> DataFrame:
    """Merge the metric blocks on (file, name); an absent metric is
    ``fill`` (the pivot equals a full outer join of the blocks)."""
    wide = blocks.groupBy("source_file", "entity_name").pivot("metric", metrics).agg(F.first("value"))
    return wide.select("source_file", "entity_name",
                       *[F.coalesce(F.col(m), F.lit(fill)).cast("bigint").alias(m) for m in metrics])


def tidy_table(cells: DataFrame, strict: bool = True) -> DataFrame:
    """G1-G4 end to end, in two passes over the cells.

    The first keeps the sheets' head rows, from which titles and blocks are
    found; these tables have a few rows per file and are stored, since the
    layout checks and the extraction read them again. The blocks' last values
    meet in one grouping by file and name, an absent metric being 0.
    """
    heads = stored(sheet_heads(cells), "sheet-heads")
    titles = stored(find_title_rows(cells, strict=strict, heads=heads), "titles")
    pairs = stored(pair_blocks(head_cells(heads), titles, strict=strict), "pairs")
    of = lambda m, c: F.when(F.col("metric") == m, F.col(c))
    return block_rows(cells, pairs, strict).groupBy("source_file", "entity_name").agg(
        *[F.coalesce(F.max_by(of(m, "value"), of(m, "row")), F.lit(0)).cast("bigint").alias(m) for m in METRICS])
