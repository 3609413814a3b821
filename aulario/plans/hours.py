"""Timetable hours per site, area, cycle and grade, with totals per site and grade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.functions.mapping import map_or_null
from aulario.functions.numbers import to_number
from aulario.functions.text import norm_text
from aulario.operators import grid
from aulario.operators.joins import group_total_back, join_lookup
from aulario.operators.reshape import backfill, expand_values, replicate_value, unpivot_columns
from aulario.plans import constants as K
from aulario.sources.stages import stage


def timetable_hours(cells: DataFrame, year: int) -> DataFrame:
    """Weekly hours unpivoted by cycle and expanded to grades, with yearly totals.

    A site's name stands below its rows. A site without a code gets a null name and, as a
    null group, no totals.
    """
    first, last = K.HOURS_SKIPPED_ROWS
    body = cells.filter(
        (F.col("sheet") == K.HOURS_SHEET)
        & (F.col("row") >= K.HOURS_FIRST_ROW)
        & ~F.col("row").between(first, last)
        & F.col("col").between(K.HOURS_CONCEPT_COL, max(K.HOURS_CYCLES.values()))
    )
    lines = grid.records(body).select(
        *grid.SHEET,
        "row",
        F.col("cells")[K.HOURS_CONCEPT_COL].alias("concepto"),
        *[F.col("cells")[col].alias(c) for c, col in K.HOURS_CYCLES.items()],
    )
    # The grid is read once; the labels, the cycles and the hours are taken from its lines.
    lines = stage(lines, "lines")
    rows = lines.withColumn("_site", F.when(F.col("concepto").isin(*K.HOURS_SITES), F.col("concepto")))
    rows = backfill(rows, grid.SHEET, "row", "_site", "sede")

    cycle_grades = (
        lines.filter(F.col("concepto") == K.HOURS_VARIABLES)
        .groupBy(*grid.SHEET)
        .agg(F.min_by(F.struct(*K.HOURS_CYCLES), F.col("row")).alias("grades"))
    )
    hours = rows.filter(F.col("concepto").startswith(K.HOURS_PREFIX)).withColumn(
        "area", F.trim(F.replace("concepto", F.lit(K.HOURS_AREA_PREFIX), F.lit("")))
    )
    long = unpivot_columns(hours, [*grid.SHEET, "sede", "area"], list(K.HOURS_CYCLES), "ciclo", "horas_semanales")
    long = join_lookup(long, cycle_grades, grid.SHEET, "inner")
    grade = F.coalesce(*[F.when(F.col("ciclo") == c, F.col("grades")[c]) for c in K.HOURS_CYCLES])
    long = (
        long.withColumn("grado", grade)
        .withColumn("horas_semanales", to_number(F.col("horas_semanales")))
        .dropna(subset=["sede", "grado", "horas_semanales"])
    )
    long = expand_values(long, "grado", K.GRADE_PAIRS, "grado_detalle")
    long = long.withColumns({c: norm_text(F.col(c), collapse_spaces=False) for c in ("sede", "area", "grado_detalle")})
    long = replicate_value(long, "sede", K.SPLIT_SITE, K.SPLIT_SITES)
    site = F.when(F.col("sede").isin(*K.SPLIT_SITES), F.col("sede")).otherwise(
        map_or_null(F.col("sede"), K.SITE_CODES)
    )
    long = long.withColumn("sede", site).select("sede", "area", "ciclo", "horas_semanales", "grado_detalle")
    # Details and totals both come from the written rows.
    return with_yearly_hours(stage(long, "hours"), year)


def with_yearly_hours(hours: DataFrame, year: int) -> DataFrame:
    """Totals per site and grade: weekly hours × weeks per bimester × bimesters of the site."""
    totals = group_total_back(hours, ["sede", "grado_detalle"], "horas_semanales", "total_horas_semanales")
    known = F.col("total_horas_semanales").isNotNull()
    per_bimester = F.col("total_horas_semanales") * K.WEEKS_PER_BIMESTER
    bimesters = map_or_null(F.col("sede"), K.BIMESTERS)
    return totals.select(
        "sede",
        "area",
        "ciclo",
        "horas_semanales",
        "grado_detalle",
        "total_horas_semanales",
        F.when(known, F.lit(K.WEEKS_PER_BIMESTER)).alias("semanas_prom_bimestre"),
        per_bimester.alias("total_horas_bimestre"),
        bimesters.alias("bimestres_anio"),
        F.when(known, F.lit(0)).alias("extra_horas_anio"),
        (per_bimester * bimesters).alias("total_horas_anio"),
        F.lit(year).alias("ANIO"),
    )
