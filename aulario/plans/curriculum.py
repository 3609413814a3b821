"""Curriculum progress: one row per topic, stacked over site sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.functions.text import norm_text
from aulario.operators import grid
from aulario.plans import constants as K
from aulario.sources.readers import sheet_in
from aulario.sources.stages import stage


def curriculum_progress(cells: DataFrame, sheets: Sequence[str], header_row: int = 0) -> DataFrame:
    """Topic rows of the listed sheets, headings normalised, the sheet name as ``SEDE``.

    Headings differ between sheets; absent ones are null. Finding no listed sheet is an error.
    """
    cells = cells.filter(sheet_in(sheets))
    titles = grid.fixed_header_cells(cells, header_row)
    titles = titles.withColumn("header", norm_text(F.col("header"), collapse_spaces=False))
    titles = stage(grid.duplicate_headers(titles.filter(~F.col("header").isin(*K.CURRICULUM_DROP))), "titles")
    names = grid.heading_list(titles)
    if not names:
        raise ValueError("no listed sheet found")
    data = grid.with_layout(cells, grid.layouts(titles))
    table = grid.wide(data, names, ("sheet",))
    return table.withColumn("SEDE", norm_text(F.col("sheet"), collapse_spaces=False)).drop("sheet")
