"""Enrolment: one row per child, from sheets of differing layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.functions.dates import month_word_date
from aulario.functions.ids import document_id
from aulario.functions.mapping import map_or_keep
from aulario.functions.text import clean_cell, clean_header, contains_status, norm_label, norm_text, null_tokens
from aulario.operators import grid, named
from aulario.operators.schema import find_named
from aulario.plans import constants as K
from aulario.sources.readers import sheet_numbered
from aulario.sources.stages import stage


def _body_and_titles(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned cells of the numbered sheets, and the headings that have data below them (written once)."""
    cells = cells.filter(sheet_numbered() & (F.col("col") >= K.ENROLMENT_FIRST_COL))
    body = (
        cells.filter(F.col("row") > K.ENROLMENT_HEADER_ROW)
        .withColumn("value", clean_cell(F.col("value"), separators=False))
        .withColumn("value", null_tokens(F.col("value"), (*K.TEXT_NULLS, *K.EXCEL_ERRORS)))
    )

    titles = grid.fixed_header_cells(cells, K.ENROLMENT_HEADER_ROW, K.ENROLMENT_FIRST_COL)
    titles = grid.duplicate_headers(grid.with_data(titles, body), ".")
    titles = stage(titles.withColumn("header", clean_header(F.col("header"))), "titles")
    return body, titles


def enrolment(cells: DataFrame, year: int, exact_status: bool = True) -> DataFrame:
    """Stack the numbered sheets on the most common layout plus extra columns.

    Sheets of the common width take the reference sheet's headings by position, so a sheet
    that words a heading differently keeps its column. Missing codes stay null, and status
    words are read whole unless ``exact_status`` is off.
    """
    body, titles = _body_and_titles(cells)
    base, extra = grid.common_layout(titles)
    names = [*base, *extra]
    layout = grid.layouts(grid.duplicate_headers(grid.positional_headers(titles, base)))
    table = grid.wide(grid.with_layout(body, layout), names, ("sheet",)).withColumnRenamed("sheet", "HOJA_ORIGEN")

    id_column = find_named(names, "DNI DEL NIÑO", "DNI")
    if id_column:
        table = table.withColumn(id_column, document_id(F.col(f"`{id_column}`")))
        table = table.filter(F.col(f"`{id_column}`").isNotNull())
    columns = [F.col(f"`{c}`") for c in table.columns]
    repeated = grid.is_repeated_header(table.columns, F.array(*[norm_label(c) for c in columns]))
    table = table.filter(~repeated)

    def replace(title: str | None, change) -> None:
        nonlocal table
        if title and title in table.columns:
            table = table.withColumn(title, change(F.col(f"`{title}`")))

    def code(table_: dict[str, str]):
        def change(c: Column) -> Column:
            return map_or_keep(norm_text(c), table_)

        return change

    replace("GRADO", code(K.GRADE_NAMES))
    replace("SEXO", code(K.SEX_ENROLMENT))
    replace("CENTRO", norm_text)
    replace(find_named(names, "CONDICIÓN ACTUAL"), lambda c: contains_status(c, exact_status))
    replace(
        find_named(names, "FECHA DE REGISTRO", "FECHA REGISTRO"),
        lambda c: month_word_date(c, year, K.MONTH_WORDS, K.MONTH_WORDINGS),
    )
    return table


def enrolment_records(cells: DataFrame, year: int, exact_status: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`enrolment` as records, whatever the number of headings: ``names`` and ``records``.

    ``names(position, header, base)`` are its columns in order; ``records(file, sheet, row, fields)`` hold heading -> text,
    nulls left out, dates as ISO text. No list of headings reaches the driver; ``named.columns_of`` makes columns of some.
    """
    body, titles = _body_and_titles(cells)
    names, headers = named.named_layout(titles)
    names = stage(names, "names")
    records = named.named_records(body, headers)
    role = named.headings_named(
        names,
        {
            "id": ("DNI DEL NIÑO", "DNI"),
            "status": ("CONDICIÓN ACTUAL",),
            "date": ("FECHA DE REGISTRO", "FECHA REGISTRO"),
        },
    )
    if "id" in role:
        records = named.with_fields(records, {role["id"]: document_id(F.col("fields")[role["id"]])})
        records = records.filter(F.col("fields")[role["id"]].isNotNull())
    records = named.without_repeated_headers(stage(records, "records"), names, {"HOJA_ORIGEN": F.col("sheet")})

    changes = {
        "GRADO": lambda c: map_or_keep(norm_text(c), K.GRADE_NAMES),
        "SEXO": lambda c: map_or_keep(norm_text(c), K.SEX_ENROLMENT),
        "CENTRO": norm_text,
    }
    if "status" in role:
        changes[role["status"]] = lambda c: contains_status(c, exact_status)
    if "date" in role:
        changes[role["date"]] = lambda c: month_word_date(c, year, K.MONTH_WORDS, K.MONTH_WORDINGS)
    return names, named.with_fields(records, {t: change(F.col("fields")[t]) for t, change in changes.items()})
