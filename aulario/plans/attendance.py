"""Regular and extracurricular attendance: one row per child and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.functions.dates import date_like
from aulario.functions.ids import document_id
from aulario.functions.mapping import map_or_keep
from aulario.functions.numbers import to_number
from aulario.functions.text import (
    base_name,
    centre_before_dash,
    centre_from_file,
    clean_header,
    collapse,
    full_name,
    null_tokens,
    strip,
)
from aulario.operators import grid
from aulario.plans import constants as K
from aulario.sources.readers import sheet_like

# Sheet-name patterns on the normalised text; the first tolerates a slip.
REGULAR_SHEETS = "asist|asis.*ist|ist.*asis"
EXTRA_SHEETS = "asist"
# Heading patterns on the normalised text, first matching column wins.
REGULAR_ROLES = {
    "dni": r"\bdni\b|\bn[_\. ]*dni\b",
    "names": r"\bnombres?\b",
    "paternal": r"\bapellido\s*paterno\b|\bap[e\. ]*pat(?:erno)?\b|\bpaterno\b",
    "maternal": r"\bapellido\s*materno\b|\bap[e\. ]*mat(?:erno)?\b|\bmaterno\b",
    "surnames": r"\bapellidos?\b|\bapellidoynombres?\b|\bapellidosy?nombres?\b",
    "single": (
        r"\bapellidos?\s*y\s*nombres?\b|\bnombres?\s*y\s*apellidos?\b|\bnombre\s*y\s*apellid"
        r"|\bnombre\s*completo\b|\balumno\b|\bnombre\b"
    ),
}
EXTRA_ROLES = {
    "dni": r"\bdni\b",
    "single": r"\bapellidos?\s*y\s*nombres?\b|\bnombres?\s*y\s*apellidos?\b|\bnombre\s*completo\b",
}


def _child_name() -> Column:
    """Full name from whichever name columns a sheet has, most specific first."""

    def has(role: str) -> Column:
        return F.col(f"role_{role}").isNotNull()

    def value(role: str) -> Column:
        return F.coalesce(grid.role_cell(role), F.lit(""))

    return (
        F.when(
            has("names") & has("paternal") & has("maternal"),
            full_name(value("names"), value("paternal"), value("maternal")),
        )
        .when(has("names") & has("paternal"), full_name(value("names"), value("paternal")))
        .when(has("names") & has("surnames"), full_name(value("names"), value("surnames")))
        .when(has("single"), full_name(value("single")))
        .when(has("names"), full_name(value("names")))
        .when(has("surnames"), full_name(value("surnames")))
    )


def _long(
    cells: DataFrame,
    headers: DataFrame,
    roles: dict[str, str],
    name: Column,
    sex: dict[str, str],
    centre: Column,
    used_only: bool = False,
) -> DataFrame:
    dated = grid.within_date_range(grid.with_dates(headers))
    if used_only:
        dated = grid.compact_range(dated, cells)
    titled = grid.duplicate_headers(dated.withColumn("header", clean_header(F.col("header"))))
    tutors = grid.neighbour_of_label(cells, K.TUTOR_LABEL, "TUTOR")
    layout = grid.layouts(titled, roles).join(tutors, grid.SHEET, "left")
    data = grid.with_layout(cells, layout)

    def upper(title: str) -> Column:
        return null_tokens(strip(F.upper(grid.cell(title))), K.UPPER_NULLS)

    # The id filter comes before the dates are unrolled: it drops a row once, not per date.
    ids = {
        "DNI": document_id(grid.role_cell("dni")),
        "NOMBRE": F.nullif(name, F.lit("")),
        "CENTRO": centre,
        "GRADO": grid.cell("GRADO"),
        "SEXO": map_or_keep(upper("SEXO"), sex),
        "F_INCORPORACION": date_like(grid.cell("FECHA DE INCORPORACION")),
        "TIPO_ALUMNO": upper("TIPO DE ALUMNO"),
        "F_SALIDA": date_like(grid.cell("FECHA DE SALIDA")),
        "ALERTAS_ASISTENCIA": grid.cell("ALERTAS DE ASISTENCIA"),
        "A_ESPERADAS": to_number(grid.tail_cell(1)),
        "A_REALES": to_number(grid.tail_cell(2)),
        "PORC_PART": to_number(grid.tail_cell(3)),
        "ARCHIVO_ORIGEN": base_name(F.col("file")),
        "HOJA_ORIGEN": F.col("sheet"),
        "TUTOR": F.col("TUTOR"),
    }
    long = grid.dated_marks(data.filter(ids["DNI"].isNotNull()), ids)
    return long.withColumnsRenamed({"fecha": "FECHA", "asistencia": "ASISTENCIA"}).select(*K.ATTENDANCE_COLUMNS)


def regular_attendance(cells: DataFrame) -> DataFrame:
    """Attendance sheets with the header at a fixed cell.

    Headings are compared without accents and case. Ids lose a trailing ``.0`` before other
    characters, and a missing code stays null. In these sheets ``M`` stands for mujer. Columns
    of the date range without any entry are dropped first: a date printed in advance is no
    class day, and the totals are told by their order among what is left.
    """
    # Names are tested on the header row only: other sheets have no layout and drop out there.
    headers = grid.fixed_header_cells(cells, K.REGULAR_HEADER_ROW, K.REGULAR_FIRST_COL)
    headers = headers.filter(sheet_like(REGULAR_SHEETS))
    return _long(cells, headers, REGULAR_ROLES, _child_name(), K.SEX_REGULAR, centre_before_dash(base_name(F.col("file"))), True)


def extracurricular_attendance(cells: DataFrame, year: int) -> DataFrame:
    """Attendance sheets whose header row is searched in the top twenty rows."""
    rows = grid.header_row_with_titles(cells, K.EXTRA_REQUIRED_TITLES, K.EXTRA_NAME_TITLES)
    rows = rows.filter(sheet_like(EXTRA_SHEETS))
    headers = grid.header_cells(cells, rows, max_rows=20)
    centre = centre_from_file(base_name(F.col("file")), K.EXTRA_FILE_PREFIX, [K.EXTRA_FILE_SUFFIX.format(year=year)])
    return _long(cells, headers, EXTRA_ROLES, collapse(grid.role_cell("single")), K.SEX_EXTRA, centre)
