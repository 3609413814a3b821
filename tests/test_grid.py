import datetime as dt

import pytest
from pyspark.sql import functions as F

from aulario.operators import grid
from tests.conftest import rows

CELLS = "file string, sheet string, row int, col int, value string"


def sheet(spark, lines, name="S", file="f.xlsx", first_row=0, first_col=0):
    """Cell grid from lists of values; None makes no cell."""
    data = [
        (file, name, first_row + r, first_col + c, str(v))
        for r, line in enumerate(lines)
        for c, v in enumerate(line)
        if v is not None
    ]
    return spark.createDataFrame(data, CELLS)


def test_header_row_needs_all_titles_and_one_alternative(spark):
    lines = [["DNI", "GRADO"], [" dni ", "Grado", "Nombre completo"], ["DNI", "GRADO", "APELLIDOS Y NOMBRES"]]
    cells = sheet(spark, lines).unionByName(sheet(spark, lines, "tarde", first_row=19)).unionByName(sheet(spark, lines[:1], "no"))
    found = grid.header_row_with_titles(cells, ["DNI", "GRADO"], ["APELLIDOS Y NOMBRES", "NOMBRE COMPLETO"])
    assert rows(found, "sheet", "header_row") == [("S", 1)]


def test_header_row_containing_and_fixed(spark):
    cells = sheet(spark, [["x"], ["n° dni niño"], ["DNI"]])
    assert rows(grid.header_row_containing(cells, "DNI"), "header_row") == [(1,)]
    assert rows(grid.header_row_fixed(cells, 2), "sheet", "header_row") == [("S", 2)]
    assert grid.header_row_fixed(cells, 9).count() == 0


def test_header_cells_leave_the_cells_unshuffled(spark, tmp_path):
    sheet(spark, [["t"], ["DNI", "x"], ["1", "2"]]).write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = grid.header_cells(cells, grid.header_row_containing(cells, "DNI"))
        assert rows(found, "col", "header") == [(0, "DNI"), (1, "x")]
        assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_dates_range_and_tail(spark):
    head = ["DNI", "mar", "2025-03-04", "45000", "5/3/2025", "E", "R", "P", "fuera"]
    headers = grid.within_date_range(grid.with_dates(grid.fixed_header_cells(sheet(spark, [head]), 0)))
    got = {r["header"]: (r["date"], r["offset"]) for r in headers.collect()}
    assert "fuera" not in got and got["mar"] == (None, None)
    assert got["45000"] == (dt.date(2023, 3, 15), None) and got["P"] == (None, 3)
    none = grid.within_date_range(grid.with_dates(grid.fixed_header_cells(sheet(spark, [["DNI", "x"]]), 0)))
    assert none.count() == 0


def test_label_neighbour_passes_over_empty_ones(spark):
    cells = sheet(spark, [["TUTOR:", None, "lejos"], ["tutora: ", " Ana "], ["TUTOR:", "Luis"]])
    late = sheet(spark, [[None]] * 10 + [["TUTOR:", "tarde"]], "tarde")
    got = grid.neighbour_of_label(cells.unionByName(late), "tutora?:", "TUTOR")
    assert rows(got, "sheet", "TUTOR") == [("S", "Ana")]


def test_two_row_headers(spark):
    cells = sheet(spark, [["Visita", None, "Taller"], ["4/3/2025", "2025-03-05", "sin fecha"]])
    assert rows(grid.two_row_headers(cells, 0, 1, 1), "col", "header") == [
        (0, "2025-03-04 - Visita"),
        (1, "2025-03-05"),
        (2, "Taller"),
    ]


def test_duplicate_headers(spark):
    headers = grid.fixed_header_cells(sheet(spark, [["A", "B", "A", "A"]]), 0)
    assert rows(grid.duplicate_headers(headers), "col") == [(0,), (1,)]
    assert rows(grid.duplicate_headers(headers, "_v"), "header") == [("A",), ("A_v1",), ("A_v2",), ("B",)]
    assert rows(grid.duplicate_headers(headers, "."), "header")[1] == ("A.1",)


def test_empty_rows_and_columns_vanish(spark):
    cells = sheet(spark, [["A", "B", "C"], [" ", "", None], ["1", None, None]])
    headers = grid.with_data(grid.fixed_header_cells(cells, 0), grid.filled(cells))
    assert rows(headers, "header") == [("A",)]
    assert rows(grid.records(cells), "row") == [(0,), (2,)]


def test_common_layout_ties_go_to_the_first_sheet(spark):
    cells = (
        sheet(spark, [["A", "B", "C"]], "03")
        .unionByName(sheet(spark, [["A", "Z"]], "02"))
        .unionByName(sheet(spark, [["B", "C", "D"]], "01"))
        .unionByName(sheet(spark, [["Z", "A", "Y", "X"]], "04"))
    )
    headers = grid.fixed_header_cells(cells, 0)
    base, extra = grid.common_layout(headers)
    assert (base, extra) == (["B", "C", "D"], ["A", "Z", "Y", "X"])
    renamed = grid.positional_headers(headers, base).filter("sheet = '03'")
    assert [r["header"] for r in renamed.orderBy("col").collect()] == base
    tie = grid.fixed_header_cells(cells.filter("sheet in ('02', '04')"), 0)
    assert grid.common_layout(tie) == (["A", "Z"], ["Y", "X"])
    with pytest.raises(ValueError):
        grid.heading_list(headers, limit=2)
    assert grid.common_layout(headers.limit(0)) == ([], [])


@pytest.mark.parametrize("bound", [200_000, 0])
def test_records_with_layout_broadcast_or_salted(spark, monkeypatch, bound):
    monkeypatch.setattr(grid, "fits_broadcast", lambda df, entries=None: bound > 0)
    cells = sheet(spark, [["t"], ["A", "B"], ["1", None], [None, "2"], [" ", None]])
    data = grid.with_layout(cells, grid.layouts(grid.fixed_header_cells(cells, 1)))
    assert rows(grid.wide(data, ["A", "B", "C"]), "row", "A", "B", "C") == [(2, "1", None, None), (3, None, "2", None)]


def test_marks_keep_empty_ones(spark):
    cells = sheet(spark, [["DNI", "2025-03-04", "2025-03-05", "E"], ["7", "A", None, "2"]])
    layout = grid.layouts(grid.within_date_range(grid.with_dates(grid.fixed_header_cells(cells, 0))), {"dni": "dni"})
    data = grid.with_layout(cells, layout)
    long = grid.dated_marks(data, {"id": grid.role_cell("dni"), "e": grid.tail_cell(1), "r": grid.tail_cell(2)})
    assert rows(long) == [
        ("7", "2", None, dt.date(2025, 3, 4), "A"),
        ("7", "2", None, dt.date(2025, 3, 5), None),
    ]
    plain = grid.with_layout(cells, grid.layouts(grid.fixed_header_cells(cells, 0)))
    titled = grid.titled_marks(plain, {"id": grid.cell("DNI")}, "^2025-", "h", "v")
    assert rows(titled) == [("7", "2025-03-04", "A"), ("7", "2025-03-05", None)]


def test_repeated_header_threshold(spark):
    df = spark.createDataFrame([(["A", "B", "x", "y"],), (["A", "x", "y", "z"],), ([None, None, None, None],)], "v array<string>")
    out = [r[0] for r in df.select(grid.is_repeated_header(["A", "B", "C", "D"], F.col("v"))).collect()]
    assert out == [True, False, False]


def test_equal_dates_and_totals_all_stay(spark):
    cells = sheet(spark, [["DNI", "DNI", "2025-03-04", "2025-03-04", "TOTAL", "TOTAL"], ["7", "8", "A", "F", "2", "1"]])
    headers = grid.duplicate_headers(grid.within_date_range(grid.with_dates(grid.fixed_header_cells(cells, 0))))
    data = grid.with_layout(cells, grid.layouts(headers))
    long = grid.dated_marks(data, {"id": grid.cell("DNI"), "e": grid.tail_cell(1), "r": grid.tail_cell(2)})
    day = dt.date(2025, 3, 4)
    assert rows(long) == [("7", "2", "1", day, "A"), ("7", "2", "1", day, "F")]
