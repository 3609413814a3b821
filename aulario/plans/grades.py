"""Grades by area and competence: one row per child, area, moment and competence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.dates import largest_year
from aulario.functions.numbers import percent_to_double, to_number
from aulario.functions.text import capture_code, clean_cell, null_tokens
from aulario.operators import grid
from aulario.operators.joins import join_lookup, join_null_safe, with_equivalence
from aulario.operators.schema import project
from aulario.plans import constants as K
from aulario.sources.readers import sheet_in
from aulario.sources.stages import stage

# Target field of each sheet column.
LAYOUT = {
    "DNI": "DNI__c",
    "COMPETENCIA": "Competencia__c",
    "COMPETENCIA_TEXTO": "Competencia_texto__c",
    "VALOR_PROMEDIO": "Valor_Promedio__c",
    "VALOR_LOGRO": "Valor_alcanzado__c",
    "APELLIDOS Y NOMBRES": "APELLIDOS_Y_NOMBRES__c",
    "GRADO": "GRADO__c",
    "SEXO": "SEXO__c",
    "CENTRO": "CENTRO__c",
    "CONDICIÓN ACTUAL": "CONDICIN_ACTUAL__c",
    "AREA_EVALUACION": "REA__c",
    "TOTAL PREGUNTAS ACERTADAS": "TOTAL_PREGUNTAS_ACERTADAS__c",
    "PORCENTAJE_PROMEDIO": "PORCENTAJE_DE_PROMEDIO__c",
    "NIVEL_LOGRO_GENERAL": "NIVEL_DE_LOGRO__c",
    "MOMENTO": "ESCENARIO__c",
    "ANIO": "ANIO__c",
    "EVALUACION": "EVALUACION__c",
}
META = ("DNI", "APELLIDOS Y NOMBRES", "GRADO", "SEXO", "CENTRO", "CONDICIÓN ACTUAL", "TOTAL PREGUNTAS ACERTADAS")


def equivalences(cells: DataFrame, sheet: str = "Equivalencias Competencias", header_row: int = 2) -> DataFrame:
    """Competence texts by area and competence code, from their sheet."""
    cells = cells.filter(F.col("sheet") == sheet)
    layout = grid.layouts(grid.duplicate_headers(grid.fixed_header_cells(cells, header_row)))
    return grid.with_layout(cells, layout).select(
        *[grid.cell(title).alias(name) for title, name in K.EQUIVALENCE_HEADINGS.items()]
    )


def _cleaned(value: Column) -> Column:
    return null_tokens(clean_cell(value), K.GRADES_NULLS)


def _years(cells: DataFrame, titles: DataFrame) -> DataFrame:
    """Programme year per sheet: that of the last LB sheet read, in sheet-list order.

    A baseline sheet with the year column sets the year (possibly to nothing); every other
    sheet inherits it. ``cells`` are as read: only those of the year columns are cleaned.
    """
    source = titles.filter((F.col("MOMENTO") == "LB") & (F.col("header") == K.YEAR_HEADING))
    found = (
        join_lookup(cells, source.select(*grid.SHEET, "col", "header_row"), [*grid.SHEET, "col"], "inner")
        .filter(F.col("row") > F.col("header_row"))
        .groupBy(*grid.SHEET)
        .agg(F.max(largest_year(_cleaned(F.col("value")))).alias("year"))
    )
    sheets = titles.groupBy(*grid.SHEET).agg(
        F.min("position").alias("position"),
        F.bool_or((F.col("MOMENTO") == "LB") & (F.col("header") == K.YEAR_HEADING)).alias("sets"),
    )
    order = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    state = F.when(F.col("sets"), F.struct(F.col("year")))
    return (
        sheets.join(found, grid.SHEET, "left")
        .withColumn("ANIO", F.last(state, ignorenulls=True).over(order)["year"])
        .select(*grid.SHEET, "ANIO")
    )


def grades(cells: DataFrame, year: int, equivalence: DataFrame | None = None, match: str = "row") -> DataFrame:
    """Scores and levels of all area sheets in one scan.

    ``match="row"`` pairs a score with the level of the same spreadsheet row: no join, and a
    repeated or missing id stays one row per competence. ``match="id"`` joins scores, levels
    and child data on the id as a key, where repeated ids (and missing ones, which match each
    other) fan out: n rows with one id give up to n^3, so it is for sheets whose ids are nearly
    all distinct. A competence with several score or level columns has a row for each pair.
    """
    if equivalence is None:
        equivalence = equivalences(cells)
    sheets = F.create_map(
        *[
            x
            for i, (sheet, area, moment) in enumerate(K.GRADE_SHEETS)
            for x in (F.lit(sheet), F.struct(F.lit(area).alias("a"), F.lit(moment).alias("m"), F.lit(i).alias("i")))
        ]
    )
    raw = cells.filter(sheet_in([s for s, _, _ in K.GRADE_SHEETS]))
    cells = raw.withColumn("value", clean_cell(F.col("value"))).withColumn(
        "value", null_tokens(F.col("value"), K.GRADES_NULLS)
    )
    titles = grid.header_cells(raw, grid.header_row_containing(raw, "DNI"))
    titles = titles.withColumn("header", F.upper(clean_cell(F.col("header"))))
    titles = grid.duplicate_headers(titles).withColumns(
        {
            "MOMENTO": sheets[F.col("sheet")]["m"],
            "AREA_EVALUACION": sheets[F.col("sheet")]["a"],
            "position": sheets[F.col("sheet")]["i"],
        }
    )
    # Several small tables are derived from the headings: they are read from the grid once.
    titles = stage(titles, "titles")
    code = capture_code(F.col("header"))
    columns = (
        titles.withColumn("code", code)
        .filter(F.col("code").isNotNull())
        .groupBy(*grid.SHEET, "code")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("header").rlike(K.SCORE_HEADING), F.col("col")))).alias("scores"),
            F.sort_array(F.collect_list(F.when(F.col("header").rlike(K.LEVEL_HEADING), F.col("col")))).alias("levels"),
        )
        .filter((F.size("scores") > 0) & (F.size("levels") > 0))
    )
    # Every score column of a competence meets every level column of it; a sheet's list has an entry at least.
    def pair(s: Column, v: Column) -> Column:
        return F.struct(F.col("code").alias("COMPETENCIA"), s.alias("score_col"), v.alias("level_col"))

    of_code = F.flatten(F.transform("scores", lambda s: F.transform("levels", lambda v: pair(s, v))))
    pairs = columns.groupBy(*grid.SHEET).agg(F.flatten(F.collect_list(of_code)).alias("pairs"))
    percent = F.min(F.when(F.col("header").contains("PORCENTAJE DE PROMEDIO"), F.col("col")))
    shared = titles.groupBy(*grid.SHEET).agg(
        percent.alias("percent_col"),
        F.min("MOMENTO").alias("MOMENTO"),
        F.min("AREA_EVALUACION").alias("AREA_EVALUACION"),
    )
    layout = (
        grid.layouts(titles)
        .filter(F.col("columns")["DNI"].isNotNull())
        .join(pairs, grid.SHEET)
        .join(shared, grid.SHEET)
        .join(_years(raw, titles), grid.SHEET, "left")
    )
    data = grid.with_layout(cells, layout)
    first_term = (F.col("ANIO") == year) & (F.col("MOMENTO") == "LB")
    # What a row has once is read once, before the row becomes one per competence.
    per_row = data.select(
        *grid.SHEET,
        *[grid.cell(t).alias(t) for t in META if t != "TOTAL PREGUNTAS ACERTADAS"],
        to_number(grid.cell("TOTAL PREGUNTAS ACERTADAS")).alias("TOTAL PREGUNTAS ACERTADAS"),
        percent_to_double(F.col("cells")[F.col("percent_col")]).alias("PORCENTAJE_PROMEDIO"),
        grid.cell("NIVEL DE LOGRO").alias("NIVEL_LOGRO_GENERAL"),
        "MOMENTO",
        "AREA_EVALUACION",
        F.col("ANIO").cast("double").alias("ANIO"),
        F.when(first_term, f"{year}-I").otherwise(f"{year}-II").alias("EVALUACION"),
        "pairs",
        "row",
        F.col("cells").alias("scores"),
        F.col("cells").alias("levels"),
    )
    meta = [c for c in per_row.columns if c not in ("pairs", "row", "scores", "levels")]
    if match == "id":
        # Whole records are matched, before they become a row per competence: the same rows from a fraction of the shuffle.
        keys = [*grid.SHEET, "DNI"]
        written = stage(per_row, "grade-records")
        both = join_null_safe(written.select(*keys, "row", "scores"), written.select(*keys, "levels"), keys, "inner")
        per_row = join_null_safe(both, written.drop("row", "scores", "levels"), keys, "left")
    # The cells are read after a row's pairs are unrolled: an array of them would be computed by interpreted lambdas, and
    # the inner form of inline would compute it again to test its size.
    long = per_row.select(*[F.col(f"`{c}`") for c in meta], "scores", "levels", F.inline_outer("pairs")).select(
        *[F.col(f"`{c}`") for c in meta],
        "COMPETENCIA",
        F.col("scores")[F.col("score_col")].alias("VALOR_PROMEDIO"),
        F.col("levels")[F.col("level_col")].alias("VALOR_LOGRO"),
    )

    long = with_equivalence(long, equivalence, ["AREA_EVALUACION", "COMPETENCIA"])
    return project(long.withColumn("VALOR_PROMEDIO", to_number(F.col("VALOR_PROMEDIO"))), LAYOUT)
