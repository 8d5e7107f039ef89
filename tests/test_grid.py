import pytest

from panelkit.operators import grid as G
from panelkit.operators import joins as J


def sheet_cells(file, sheet, idx, grid):
    out = []
    for r, row in enumerate(grid):
        for c, v in enumerate(row):
            if v is not None:
                out.append((file, sheet, idx, r, c, v))
    return out


DECOY = [["Resumen PASAJEROS OPERACIONES MERCANCÍA"], ["sin tabla"], ["fin"]]
DATA = [
    ["Tráfico", None, None, None, None, None, None, None, None],
    ["Pasajeros", None, None, "Operaciones", None, None, "Mercancía (kg)", None, None],
    ["Aeropuertos", "Total", "Total", "Aeropuertos", "Total", None, "Aeropuertos", "% Var", "Total"],
    [None, "2024", "2023", None, "2024", None, None, None, "2024"],
    ["Madrid-Barajas (**)", "100", "90", "Palma / Mallorca", "7", None, "Madrid - Barajas", None, "1000.9"],
    ["Palma - Mallorca", "50", "40", "Madrid-Barajas", "9", None, "Palma-Mallorca", None, None],
    ["", "1", None, None, None, None, "Extra Aeropuerto", None, "5"],
    ["Madrid-Barajas", "120", None, "TOTAL", "16", None, "TOTAL", None, "1006"],
    ["TOTAL", "170", None, None, None, None, None, None, None],
]


@pytest.fixture()
def cells(spark):
    rows = (sheet_cells("01.Enero-Definitivo-2024.xls", "Notas", 0, DECOY)
            + sheet_cells("01.Enero-Definitivo-2024.xls", "Datos", 1, DATA))
    return spark.createDataFrame(rows, "source_file string, sheet_name string, sheet_index int, row int, "
                                       "col int, value string")


def test_title_row_skips_decoy_sheet(cells):
    t = G.find_title_rows(cells, strict=True).collect()
    assert [(r.sheet_name, r.title_row) for r in t] == [("Datos", 1)]


def test_block_pairs_next_total(cells):
    p = G.pair_blocks(cells, G.find_title_rows(cells), strict=True).orderBy("block").collect()
    assert [(r.metric, r.name_col, r.total_col) for r in p] == [
        ("passengers", 0, 1), ("operations", 3, 4), ("cargo_kg", 6, 8)]


def test_tidy_table(cells):
    t = {r.entity_name: (r.passengers, r.operations, r.cargo_kg)
         for r in G.tidy_table(cells, strict=True).collect()}
    # repeated name keeps the last row (120); blank name skipped; NaN -> 0;
    # 1000.9 truncates; a name missing from a block gets 0.
    assert t == {"MADRID-BARAJAS": (120, 9, 1000), "PALMA-MALLORCA": (50, 7, 0),
                 "EXTRA AEROPUERTO": (0, 0, 5)}


def test_missing_total_row_fails(spark, cells):
    bad = cells.where("NOT (sheet_index = 1 AND col = 0 AND row = 8)")
    with pytest.raises(ValueError):
        G.tidy_table(bad, strict=True)


def test_bad_header_fails(spark, cells):
    bad = cells.where("NOT (sheet_index = 1 AND row = 2 AND col = 6)")
    with pytest.raises(ValueError):
        G.pair_blocks(bad, G.find_title_rows(bad), strict=True)


def test_unmapped_entity_fails(spark, cells):
    dim = spark.createDataFrame([("MADRID-BARAJAS", "Madrid"), ("PALMA-MALLORCA", "Illes Balears")],
                                "entity_name string, province string")
    with pytest.raises(ValueError):
        J.unmapped(G.tidy_table(cells), dim, "entity_name", strict=True)
