"""Cell grids derived from the test tables, in the layout spreadsheets arrive in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def row_cells(df: DataFrame, file, sheet, row, columns: Mapping[int, Column]) -> DataFrame:
    """One cell per row and listed column; null values make no cell."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("col"), v.cast("string").alias("value")) for c, v in columns.items()]
    )
    return (
        df.select(
            _as_column(file).alias("file"),
            _as_column(sheet).alias("sheet"),
            _as_column(row).cast("int").alias("row"),
            F.inline(cells),
        )
        .filter(F.col("value").isNotNull())
        .select("file", "sheet", "row", "col", "value")
    )


def title_cells(sheets: DataFrame, row, titles: Mapping[int, str]) -> DataFrame:
    """The same titles in a row of every sheet (``sheets`` has file and sheet)."""
    return row_cells(sheets, F.col("file"), F.col("sheet"), row, {c: F.lit(t) for c, t in titles.items()})


def single_cells(df: DataFrame, file, sheet, row, col, value) -> DataFrame:
    """One cell per row of ``df`` at computed positions."""
    return df.select(
        _as_column(file).alias("file"),
        _as_column(sheet).alias("sheet"),
        _as_column(row).cast("int").alias("row"),
        _as_column(col).cast("int").alias("col"),
        _as_column(value).cast("string").alias("value"),
    ).filter(F.col("value").isNotNull())
