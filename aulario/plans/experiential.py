"""Experiential activities: one row per child and dated activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.dates import month_name, parse_date
from aulario.functions.numbers import to_number
from aulario.functions.text import split_two
from aulario.operators import grid
from aulario.plans import constants as K


def experiential_attendance(cells: DataFrame, year: int, skip: int = 2) -> DataFrame:
    """Unroll the activity columns of the register.

    Headings join the date and activity rows; id columns are found by position and the four
    totals by position from the last column. The first ``skip`` rows with an id are headings.
    """
    cells = grid.filled(cells.filter((F.col("sheet") == K.EXPERIENTIAL_SHEET) & (F.col("row") >= 1)))
    headers = grid.two_row_headers(
        cells, K.EXPERIENTIAL_ACTIVITY_ROW, K.EXPERIENTIAL_DATE_ROW, K.EXPERIENTIAL_DATE_ROW
    ).filter(F.col("header").startswith(f"{year}-"))
    id_col = K.EXPERIENTIAL_ID_COLS["DNI"]
    # Only the first rows of a sheet are ranked; the rank limit applies before the shuffle.
    top = (
        cells.filter(F.col("col") == id_col)
        .select(*grid.SHEET, "row")
        .withColumn("_n", F.row_number().over(Window.partitionBy(*grid.SHEET).orderBy("row")))
        .filter(F.col("_n") <= skip)
        .groupBy(*grid.SHEET)
        .agg(F.max("row").alias("header_row"))
    )
    width = cells.groupBy(*grid.SHEET).agg(F.max("col").alias("last_col"))
    activities = headers.groupBy(*grid.SHEET).agg(
        F.sort_array(F.collect_list(F.struct("col", "header"))).alias("activities")
    )
    layout = activities.join(top, grid.SHEET).join(width, grid.SHEET)
    data = grid.with_layout(cells, layout, F.size("activities")).filter(F.col("cells")[id_col].isNotNull())
    ids = {name: F.col("cells")[col] for name, col in K.EXPERIENTIAL_ID_COLS.items()}
    ids["DNI"] = F.regexp_replace(F.trim(ids["DNI"]), r"^(\d+)\.0+$", "$1")
    n = len(K.EXPERIENTIAL_TOTALS)
    for i, name in enumerate(K.EXPERIENTIAL_TOTALS):
        value = F.col("cells")[F.col("last_col") - (n - 1 - i)]
        ids[name] = value if i == n - 1 else to_number(value)
    marks = F.transform(
        F.filter("activities", lambda a: a["col"] <= F.col("last_col") - n),
        lambda a: F.struct(a["header"].alias("_heading"), F.col("cells")[a["col"]].alias("VALOR")),
    )
    long = grid.unroll(data, ids, marks)
    date, activity = split_two(F.col("_heading"))
    long = long.withColumns({"FECHA": parse_date(date), "ACTIVIDAD": activity})
    return long.withColumn("MES", month_name(F.col("FECHA"))).drop("_heading")
