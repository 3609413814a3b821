"""Entity plans end to end, on cell grids and form tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aulario.operators.combine import union_aligned, union_years
from aulario.plans import constants as K
from aulario.plans.attendance import extracurricular_attendance, regular_attendance
from aulario.plans.curriculum import curriculum_progress
from aulario.plans import enrolment as enrolment_plans
from aulario.plans.enrolment import enrolment
from aulario.plans.experiential import experiential_attendance
from aulario.plans.forms import enrolment_request, parent_survey, social_record
from aulario.plans.grades import grades
from aulario.plans.hours import timetable_hours
from aulario.plans.load import prepare_load
from aulario.plans.skills import skills
from aulario.queries.cells import row_cells, single_cells, title_cells
from aulario.queries.register import Registry, table
from aulario.sources.stages import stage

REGISTRY = Registry()
query = REGISTRY.query

def serial(date) -> Column:
    """Spreadsheet serial of a date."""
    return F.datediff(date, F.lit("1899-12-30").cast("date"))


def choose(index: Column, values) -> Column:
    """values[index] as a column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_choose(index: str, values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{index} + 1]"


def mixed_date(d: Column, index: Column) -> Column:
    """A date as ISO text, day-first text or serial, by index 0, 1, 2."""
    return (
        F.when(index == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(index == 1, F.date_format(d, "dd/MM/yyyy"))
        .otherwise(serial(d).cast("string"))
    )


# --- regular attendance ------------------------------------------------------------------


def workbook(*parts):
    """Stack the parts of a grid and write it, as grids reach the plans as files."""
    return stage(union_aligned(parts), "cells")


def regular_cells(spark, sf):
    """Seven workbooks: children are users, dates the days with events, marks the day's event."""
    e = table(spark, sf, "events").selectExpr(
        "user_id", "user_id % 7 as f", "cast(ts as date) as d", "event_type"
    )
    name = F.concat(F.lit("0"), "f", F.lit(" CENTRO "), "f", F.lit(" - REGISTRO DE ASISTENCIA.xlsx"))
    day = F.datediff(F.col("d"), F.lit("2024-01-01").cast("date"))
    sheet, first = "Asistencia ", 12
    children = e.groupBy("f", "user_id").agg(
        F.min("event_type").alias("t"),
        F.min("d").alias("d0"),
        F.max("d").alias("d1"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("d").alias("k"),
    )
    last = e.groupBy("f").agg(F.max(day).alias("last"))
    files = last.select(name.alias("file"), F.lit(sheet).alias("sheet"))
    titles = {
        2: "DNI", 3: "NOMBRES", 4: "APELLIDO PATERNO", 5: "APELLIDO MATERNO", 6: "GRADO", 7: "SEXO",
        8: "FECHA DE INCORPORACIÓN", 9: "TIPO DE ALUMNO", 10: "FECHA DE SALIDA", 11: "ALERTAS DE ASISTENCIA",
    }
    row = 7 + F.col("user_id")
    id_text = F.concat((70_000_000 + F.col("user_id")).cast("string"), F.when(F.col("n") > 60, ".0").otherwise(""))
    attributes = {
        2: id_text,
        3: F.concat(F.lit(" Niño  "), "user_id"),
        4: F.lit("PÉREZ"),
        5: F.upper("t"),
        6: F.lit("1ER GRADO"),
        7: F.when(F.col("k") > 25, "m").when(F.col("k") > 20, "H ").when(F.col("k") > 15, "otro"),
        8: serial("d0"),
        9: F.when(F.col("n") > 65, " activo").otherwise("nan"),
        10: F.date_format("d1", "dd/MM/yyyy"),
    }
    marks = e.groupBy("f", "user_id", "d").agg(F.min("event_type").alias("mark"))
    totals = children.join(last, "f")
    at = first + F.col("last")
    tail = [(1, F.col("n")), (2, F.col("k")), (3, F.col("k") / F.col("n")), (4, F.lit("obs"))]
    return workbook(
        *[
            title_cells(files, 2, {3: "TUTORA:", 4: "  Rosa  "}),
            title_cells(files, 6, titles),
            single_cells(e.select("f", "d").distinct(), name, sheet, 6, first + day, mixed_date(F.col("d"), day % 3)),
            *[single_cells(last, name, sheet, 6, at + i, F.lit(f"TOTAL {i}")) for i, _ in tail],
            # A date printed in advance, without a mark, before the first day of classes.
            single_cells(last, name, sheet, 6, F.lit(first - 1), F.lit("2023-12-31")),
            row_cells(children, name, sheet, row, attributes),
            single_cells(marks, name, sheet, row, first + day, F.upper("mark")),
            *[single_cells(totals, name, sheet, row, at + i, v) for i, v in tail],
            # A totals line without an id, and a sheet that is no attendance sheet.
            single_cells(last, name, sheet, 50_000_000, at, F.lit("999")),
            title_cells(files.withColumn("sheet", F.lit("Notas")), 6, titles),
        ]
    )


_REGULAR = """WITH e AS (SELECT user_id, user_id % 7 AS f, ts::DATE AS d, event_type FROM events),
  u AS (SELECT f, user_id, min(event_type) AS t, min(d) AS d0, max(d) AS d1, count(*) AS n, count(DISTINCT d) AS k
    FROM e GROUP BY 1, 2),
  dd AS (SELECT DISTINCT f, d FROM e),
  m AS (SELECT user_id, d, upper(min(event_type)) AS mark FROM e GROUP BY 1, 2),
  r AS (SELECT (70000000 + user_id)::VARCHAR AS "DNI", 'PÉREZ ' || upper(t) || ', Niño ' || user_id AS "NOMBRE",
    '0' || f || ' CENTRO ' || f AS "CENTRO", '1ER GRADO' AS "GRADO",
    CASE WHEN k > 25 THEN 'FEMENINO' WHEN k > 20 THEN 'MASCULINO' WHEN k > 15 THEN 'OTRO' END AS "SEXO",
    d0 AS "F_INCORPORACION", CASE WHEN n > 65 THEN 'ACTIVO' END AS "TIPO_ALUMNO", d1 AS "F_SALIDA",
    NULL::VARCHAR AS "ALERTAS_ASISTENCIA", d AS "FECHA", mark AS "ASISTENCIA", n::DOUBLE AS "A_ESPERADAS",
    k::DOUBLE AS "A_REALES", k / n::DOUBLE AS "PORC_PART",
    '0' || f || ' CENTRO ' || f || ' - REGISTRO DE ASISTENCIA.xlsx' AS "ARCHIVO_ORIGEN", 'Asistencia ' AS "HOJA_ORIGEN",
    'Rosa' AS "TUTOR" FROM u JOIN dd USING (f) LEFT JOIN m USING (user_id, d))
  """


@query(_REGULAR + "SELECT * FROM r")
def entity_regular_attendance(spark, sf):
    return regular_attendance(regular_cells(spark, sf))


@query(
    _REGULAR
    + """SELECT "DNI" AS "DNI__c", "NOMBRE" AS "NOMBRE__c", "CENTRO" AS "CENTRO__c", "GRADO" AS "GRADO__c", "SEXO" AS "SEXO__c",
      strftime("F_INCORPORACION", '%Y-%m-%d') AS "F_INCORPORACION__c", "TIPO_ALUMNO" AS "TIPO_ALUMNO__c",
      strftime("F_SALIDA", '%Y-%m-%d') AS "F_SALIDA__c", "ALERTAS_ASISTENCIA" AS "ALERTAS_ASISTENCIA__c",
      strftime("FECHA", '%Y-%m-%d') AS "FECHA__c", "ASISTENCIA" AS "ASISTENCIA__c", "A_ESPERADAS" AS "A_ESPERADAS__c",
      "A_REALES" AS "A_REALES__c", "PORC_PART" AS "PORC_PART__c", "ARCHIVO_ORIGEN" AS "ARCHIVO_ORIGEN__c",
      "HOJA_ORIGEN" AS "HOJA_ORIGEN__c", "TUTOR" AS "TUTOR__c", y AS "ANIO_FUENTE__c"
    FROM r, (VALUES ('2025'), ('2026')) v(y)"""
)
def load_regular_attendance(spark, sf):
    """Two years consolidated and prepared for the target object."""
    long = regular_attendance(regular_cells(spark, sf))
    return prepare_load(union_years({"2025": long, "2026": long}), "regular_attendance")


@query(
    _REGULAR
    + """, k AS (SELECT "DNI", max("A_REALES") / nullif(max("A_ESPERADAS"), 0) AS x FROM r GROUP BY "DNI")
    SELECT "CENTRO" AS "CENTRO__c", round(avg(x), 9) AS mean_attendance
    FROM (SELECT DISTINCT "CENTRO", "DNI" FROM r) JOIN k USING ("DNI") GROUP BY "CENTRO" """
)
def workbook_to_measure(spark, sf):
    """Cells to long table to load table to mean attendance, in one plan."""
    from aulario.operators.measures import FilterContext
    from aulario.plans.dashboard import measure

    loaded = prepare_load(regular_attendance(regular_cells(spark, sf)), "regular_attendance")
    out = measure("1.8", {"attendance": loaded}, FilterContext(by=("CENTRO__c",)))
    return out.withColumn("mean_attendance", F.round("mean_attendance", 9))


# --- extracurricular attendance ----------------------------------------------------------


@query(
    """WITH o AS (SELECT o_custkey, o_custkey % 9 AS f, date_trunc('month', o_orderdate)::DATE AS d, o_orderstatus AS s,
      o_totalprice FROM orders),
    u AS (SELECT f, o_custkey, min(s) AS s0, count(*) AS n, count(DISTINCT d) AS k FROM o GROUP BY 1, 2),
    dd AS (SELECT DISTINCT f, d FROM o), m AS (SELECT o_custkey, d, min(s) AS mark FROM o GROUP BY 1, 2)
    SELECT (o_custkey + 1)::VARCHAR AS "DNI", 'Apellido, Nombre ' || o_custkey AS "NOMBRE", 'SEDE_' || f AS "CENTRO",
      'G' || n AS "GRADO", CASE s0 WHEN 'F' THEN 'FEMENINO' WHEN 'O' THEN 'O' END AS "SEXO", NULL::DATE AS "F_INCORPORACION",
      NULL::VARCHAR AS "TIPO_ALUMNO", NULL::DATE AS "F_SALIDA", NULL::VARCHAR AS "ALERTAS_ASISTENCIA", d AS "FECHA",
      mark AS "ASISTENCIA", n::DOUBLE AS "A_ESPERADAS", k::DOUBLE AS "A_REALES", NULL::DOUBLE AS "PORC_PART",
      'TALLERES_SEDE_' || f || ' REGISTRO DE ASISTENCIA 2025.xlsx' AS "ARCHIVO_ORIGEN", 'Lista asist' AS "HOJA_ORIGEN",
      CASE WHEN f > 4 THEN 'Luis' END AS "TUTOR" FROM u JOIN dd USING (f) LEFT JOIN m USING (o_custkey, d)"""
)
def entity_extracurricular_attendance(spark, sf):
    """Nine workbooks with the header at different rows, one column per month of orders."""
    o = table(spark, sf, "orders").selectExpr(
        "o_custkey",
        "o_custkey % 9 as f",
        "cast(trunc(cast(o_orderdate as date), 'month') as date) as d",
        "o_orderstatus as s",
    )
    name = F.concat(F.lit("TALLERES_SEDE_"), "f", F.lit(" REGISTRO DE ASISTENCIA 2025.xlsx"))
    sheet, top = "Lista asist", 3 + F.col("f") % 10
    month = F.months_between("d", F.lit("1995-01-01").cast("date")).cast("int")
    children = o.groupBy("f", "o_custkey").agg(
        F.min("s").alias("s0"), F.count(F.lit(1)).alias("n"), F.count_distinct("d").alias("k")
    )
    last = o.groupBy("f").agg(F.max(month).alias("last"))
    row, at = top + 1 + F.col("o_custkey"), 4 + F.col("last")
    titles = {0: F.lit("DNI"), 1: F.lit("GRADO"), 2: F.lit("APELLIDOS Y NOMBRES"), 3: F.lit("SEXO")}
    values = {
        0: F.concat((F.col("o_custkey") + 1).cast("string"), F.lit(".0")),
        1: F.concat(F.lit("G"), "n"),
        2: F.concat(F.lit("Apellido,  Nombre "), "o_custkey"),
        3: F.when(F.col("s0") != "P", F.col("s0")),
    }
    marks = o.groupBy("f", "o_custkey", "d").agg(F.min("s").alias("mark"))
    totals = children.join(last, "f")
    cells = workbook(
        *[
            row_cells(last, name, sheet, 1, {1: F.when(F.col("f") > 4, "tutor: ").otherwise("nombre:"), 2: F.lit("Luis")}),
            row_cells(last, name, sheet, 0, {0: F.lit("DNI")}),
            row_cells(last, name, sheet, top, titles),
            single_cells(o.select("f", "d").distinct(), name, sheet, top, 4 + month, mixed_date(F.col("d"), month % 3)),
            single_cells(last, name, sheet, top, at + 1, F.lit("mar")),
            single_cells(last, name, sheet, top, at + 2, F.lit("abr")),
            row_cells(children, name, sheet, row, values),
            single_cells(marks, name, sheet, row, 4 + month, F.col("mark")),
            single_cells(totals, name, sheet, row, at + 1, F.col("n")),
            single_cells(totals, name, sheet, row, at + 2, F.col("k")),
        ]
    )
    return extracurricular_attendance(cells, 2025)


# --- enrolment ---------------------------------------------------------------------------


_ENROLMENT = """SELECT c_custkey::VARCHAR AS "N", (c_custkey + 1)::VARCHAR AS "DNI", c_name AS "APELLIDOS Y NOMBRES",
  CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'PRIMERO' ELSE c_mktsegment END AS "GRADO",
  CASE WHEN c_acctbal > 5000 THEN 'FEMENINO' WHEN c_acctbal > 0 THEN 'MASCULINO' END AS "SEXO", 'CENTRO UNICO' AS "CENTRO",
  CASE WHEN c_acctbal > 8000 THEN 'ACTIVO' WHEN c_acctbal > 3000 THEN 'INACTIVO' END AS "CONDICION ACTUAL",
  CASE WHEN c_acctbal > 7000 THEN DATE '2025-08-01' WHEN c_acctbal > 4000 THEN DATE '2025-03-04'
    WHEN c_acctbal > 2000 THEN DATE '2024-09-01' END AS "FECHA DE REGISTRO",
  CASE WHEN c_nationkey % 3 = 2 THEN '9' || c_custkey END AS "TELEFONO",
  ['01 A', '02 B', ' 03 C'][c_nationkey % 3 + 1] AS "HOJA_ORIGEN" FROM customer"""


def enrolment_cells(spark, sf):
    """Two sheets of the common width (one wording a heading differently) and a wider one."""
    c = table(spark, sf, "customer").withColumn("i", F.col("c_nationkey") % 3)
    sheet = choose(F.col("i"), ["01 A", "02 B", " 03 C"])
    base = ["N°", "DNI", "Apellidos y  nombres", "GRADO", "SEXO", "CENTRO", "CONDICIÓN ACTUAL (*)", "FECHA_DE REGISTRO"]
    sheets = c.select(F.lit("f").alias("file"), sheet.alias("sheet"), "i").distinct()
    titles = {2 + p: t for p, t in enumerate(base)}
    other = titles | {7: "SEDE"}
    balance = F.col("c_acctbal")
    values = {
        2: F.col("c_custkey"),
        3: F.concat((F.col("c_custkey") + 1).cast("string"), F.lit(".00")),
        4: F.concat("c_name", F.lit("\t ")),
        5: F.when(F.col("c_mktsegment") == "MACHINERY", "#N/A")
        .when(F.col("c_mktsegment") == "BUILDING", "1er  Grado")
        .otherwise(F.col("c_mktsegment")),
        6: F.when(balance > 5000, "mujer").when(balance > 0, "M"),
        7: F.lit("Centro\n único"),
        8: F.when(balance > 8000, "Activo").when(balance > 5000, "Retirado").when(balance > 3000, "INACTIVO").otherwise("NaN"),
        9: F.when(balance > 7000, "Agosto").when(balance > 4000, "4/3/2025").when(balance > 2000, "set24").otherwise("s/f"),
        10: F.when(F.col("i") == 2, F.concat(F.lit("9"), "c_custkey")),
    }
    repeated = {k: F.lit(v) for k, v in titles.items()} | {3: F.lit("DNI 1")}
    return workbook(
        *[
            title_cells(sheets.filter("i = 0"), 4, titles),
            title_cells(sheets.filter("i = 1"), 4, other),
            title_cells(sheets.filter("i = 2"), 4, titles | {10: "Teléfono"}),
            row_cells(sheets, F.col("file"), F.col("sheet"), 5, repeated),
            row_cells(c, "f", sheet, F.col("c_custkey") + 6, values),
            title_cells(sheets.withColumn("sheet", F.lit("Notas")), 4, {2: "DNI", 3: "OTRO"}),
            # A heading without data below it does not count as a column.
            title_cells(sheets, 4, {12: "VACIA"}),
        ]
    )


@query(_ENROLMENT)
def entity_enrolment(spark, sf):
    return enrolment(enrolment_cells(spark, sf), 2025)


_FIELDS = ["N", "DNI", "APELLIDOS Y NOMBRES", "GRADO", "SEXO", "CENTRO", "CONDICION ACTUAL", "FECHA DE REGISTRO", "TELEFONO"]


@query(
    f"""WITH e AS ({_ENROLMENT}), t AS (SELECT "HOJA_ORIGEN", {", ".join(f'"{c}"::VARCHAR AS "{c}"' for c in _FIELDS)} FROM e)
    SELECT trim("HOJA_ORIGEN") AS sheet, ("N"::INTEGER + 6)::INTEGER AS fila, u.header, u.value
    FROM t, LATERAL (VALUES {", ".join(f"('{c}', {chr(34)}{c}{chr(34)})" for c in _FIELDS)}) u(header, value) WHERE u.value IS NOT NULL"""
)
def enrolment_records(spark, sf):
    """The same rows by heading, without a list of headings."""
    _, records = enrolment_plans.enrolment_records(enrolment_cells(spark, sf), 2025)
    return records.select(F.trim("sheet").alias("sheet"), F.col("row").alias("fila"), F.explode("fields").alias("header", "value"))


# --- grades ------------------------------------------------------------------------------

_GRADE_YEARS = "[2025, 2025, 2025, 2025, 2024, 2024, NULL, NULL, 2025, 2025]"
_GRADES = f"""WITH g AS (SELECT l_orderkey AS k, l_orderkey % 10 AS i, max(l_tax) AS pct, min(l_returnflag) AS nivel, count(*) AS n
    FROM lineitem GROUP BY 1, 2),
  c AS (SELECT unnest(range(1, 8)) AS c), s AS (SELECT l_orderkey AS k, l_linenumber AS c, max(l_quantity) AS q, min(l_linestatus) AS l
    FROM lineitem GROUP BY 1, 2),
  eq AS (SELECT {sql_choose("n_nationkey % 5", ["Matemática", "Comunicación", "Socioemocional", "Tecnología", "Ciencias"])} AS a,
    'C' || (n_nationkey // 5 + 1) AS c, n_name FROM nation)
  SELECT '7' || k AS "DNI__c", 'C' || c.c AS "Competencia__c", eq.n_name AS "Competencia_texto__c", q AS "Valor_Promedio__c",
    l AS "Valor_alcanzado__c", 'Niño ' || k AS "APELLIDOS_Y_NOMBRES__c", 'G' || n AS "GRADO__c", NULL::VARCHAR AS "SEXO__c",
    'Centro' AS "CENTRO__c", 'Activo' AS "CONDICIN_ACTUAL__c",
    {sql_choose("i // 2", ["Matemática", "Comunicación", "Socioemocional", "Tecnología", "Ciencias"])} AS "REA__c",
    n::DOUBLE AS "TOTAL_PREGUNTAS_ACERTADAS__c", pct AS "PORCENTAJE_DE_PROMEDIO__c", nivel AS "NIVEL_DE_LOGRO__c",
    ['LB', 'LS'][i % 2 + 1] AS "ESCENARIO__c", {_GRADE_YEARS}[i + 1]::DOUBLE AS "ANIO__c",
    CASE WHEN {_GRADE_YEARS}[i + 1] = 2025 AND i % 2 = 0 THEN '2025-I' ELSE '2025-II' END AS "EVALUACION__c"
  FROM g CROSS JOIN c LEFT JOIN s ON s.k = g.k AND s.c = c.c
  LEFT JOIN eq ON eq.a = {sql_choose("i // 2", ["Matemática", "Comunicación", "Socioemocional", "Tecnología", "Ciencias"])}
    AND eq.c = 'C' || c.c""".replace("SELECT '7' || k", "SELECT '7' || g.k").replace("'Niño ' || k", "'Niño ' || g.k")


def grade_cells(spark, sf):
    """Ten area sheets: children are orders, competences the line numbers."""
    l = table(spark, sf, "lineitem")
    per_child = l.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("l_tax").alias("pct"),
        F.min("l_returnflag").alias("nivel"),
        F.count(F.lit(1)).alias("n"),
        *[F.max(F.when(F.col("l_linenumber") == c, F.col("l_quantity"))).alias(f"q{c}") for c in range(1, 8)],
        *[F.min(F.when(F.col("l_linenumber") == c, F.col("l_linestatus"))).alias(f"l{c}") for c in range(1, 8)],
    )
    index = F.col("k") % 10
    sheet = choose(index, [s for s, _, _ in K.GRADE_SHEETS])
    # Baseline sheets: year given, no year column, another year, column without a year, year given.
    year = choose(index, ["Desde 2024 a 2025", None, None, None, "2024", None, "s/d", None, "2025", None])
    values = {
        0: F.concat(F.lit("7"), "k"),
        1: F.concat(F.lit("Niño;  "), "k"),
        2: F.concat(F.lit("G"), "n"),
        3: F.lit("nan"),
        4: F.lit("Centro"),
        5: F.lit("Activo"),
        6: F.col("n"),
        7: year,
        22: F.concat(F.col("pct").cast("string"), F.lit("%")),
        23: F.col("nivel"),
    }
    titles = {
        0: "DNI", 1: "Apellidos y\nNombres", 2: "Grado", 3: "Sexo", 4: "Centro", 5: "Condición actual",
        6: "Total preguntas acertadas", 22: "Porcentaje de promedio (%)", 23: "Nivel de logro",
    }
    for c in range(1, 8):
        titles |= {6 + 2 * c: f"Promedio C{c}", 7 + 2 * c: f"Nivel de logro  C{c}"}
        values |= {6 + 2 * c: F.col(f"q{c}"), 7 + 2 * c: F.col(f"l{c}")}
    # From the numbers themselves: the children need not be gathered for ten sheets.
    numbers = l.select((F.col("l_orderkey") % 10).alias("k")).distinct()
    sheets = numbers.select(F.lit("comparativa").alias("file"), sheet.alias("sheet"), index.alias("i"))
    return workbook(
        *[
            title_cells(sheets, 0, {0: "REPORTE"}),
            title_cells(sheets, 3, titles),
            title_cells(sheets.filter("i in (0, 4, 6, 8)"), 3, {7: "Permanencia"}),
            row_cells(per_child, "comparativa", sheet, F.col("k") + 4, values),
        ]
    )


def competence_texts(spark, sf):
    areas = ["Matemática", "Comunicación", "Socioemocional", "Tecnología", "Ciencias"]
    return table(spark, sf, "nation").select(
        choose(F.col("n_nationkey") % 5, areas).alias("AREA_EVALUACION"),
        F.concat(F.lit("C"), F.expr("n_nationkey div 5 + 1").cast("string")).alias("COMPETENCIA"),
        F.col("n_name").alias("COMPETENCIA_TEXTO"),
    )


@query(_GRADES)
def entity_grades(spark, sf):
    return grades(grade_cells(spark, sf), 2025, competence_texts(spark, sf))


@query(_GRADES)
def entity_grades_by_id(spark, sf):
    """The same with scores, levels and child data joined on the id."""
    return grades(grade_cells(spark, sf), 2025, competence_texts(spark, sf), match="id")


# --- forms -------------------------------------------------------------------------------


def _answers(spark, sf):
    return table(spark, sf, "orders").withColumn(
        "stamp",
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:00:00")))
        .otherwise("sin fecha"),
    )


_STAMP = """CASE WHEN o_orderstatus = 'F' THEN o_orderdate WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '10 hours' END"""
_LAST = "row_number() OVER (PARTITION BY doc ORDER BY stamp DESC NULLS {n}, lpad(o_orderkey::VARCHAR, 12, '0') DESC)"


@query(
    f"""SELECT stamp::DATE AS "Marca temporal", doc AS "N Documento Apoderado", o_custkey::VARCHAR || '-H' AS "N Documento Niño",
      CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE upper(o_orderpriority) || ' MAS' END AS "Respuesta",
      lpad(o_orderkey::VARCHAR, 12, '0') AS "Folio"
    FROM (SELECT *, {_STAMP} AS stamp, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE nullif(o_custkey, 0)::VARCHAR END AS doc FROM orders)
    QUALIFY {_LAST.format(n="FIRST")} = 1"""
)
def entity_parent_survey(spark, sf):
    form = _answers(spark, sf).select(
        F.col("stamp").alias("Marca temporal"),
        F.when(F.col("o_orderpriority") == "5-LOW", "--")
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .alias("N° de documento"),
        F.concat("o_custkey", F.lit("-h ")).alias("N° de documento "),
        F.when(F.col("o_orderpriority") == "2-HIGH", "nan")
        .otherwise(F.concat(F.col("o_orderpriority"), F.lit("   más ")))
        .alias("Respuesta"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("Folio"),
    )
    return parent_survey(form, tiebreak=["Folio"])


@query(
    f"""SELECT stamp AS "Marca temporal", doc AS "Número de documento del niño", o_orderpriority AS "Parentesco",
      o_orderstatus AS "Parentesco_v1", lpad(o_orderkey::VARCHAR, 12, '0') AS "Folio"
    FROM (SELECT *, {_STAMP} AS stamp, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey::VARCHAR END AS doc FROM orders)
    QUALIFY {_LAST.format(n="FIRST")} = 1"""
)
def entity_social_record(spark, sf):
    form = _answers(spark, sf).select(
        F.col("stamp").alias("Marca temporal"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias(
            "Número de documento del niño"
        ),
        F.col("o_orderpriority").alias("Parentesco"),
        F.col("o_orderstatus").alias("Parentesco"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("Folio"),
    )
    return social_record(form, tiebreak=["Folio"])


@query(
    f"""SELECT stamp::DATE AS "Marca temporal", doc AS "Número de Documento", NULL::VARCHAR AS "Número de Documento.1",
      o_orderdate::DATE AS "Fecha de nacimiento",
      CASE o_orderpriority WHEN '1-URGENT' THEN 'TEA' WHEN '2-HIGH' THEN 'NINGUNA' WHEN '3-MEDIUM' THEN 'VISUAL'
        WHEN '4-NOT SPECIFIED' THEN 'OTRO' END AS "¿Qué discapacidad tiene?",
      lpad(o_orderkey::VARCHAR, 12, '0') AS "Folio",
      trunc(date_diff('day', o_orderdate::DATE, DATE '2025-06-30') / 365.25)::INTEGER AS "EDAD"
    FROM (SELECT *, {_STAMP} AS stamp, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE nullif(o_custkey, 0)::VARCHAR END AS doc FROM orders)
    QUALIFY doc IS NULL OR {_LAST.format(n="LAST")} = 1"""
)
def entity_enrolment_request(spark, sf):
    form = _answers(spark, sf).select(
        F.col("stamp").alias("Marca temporal"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias(
            "Número de Documento"
        ),
        F.lit("0").alias("Número de Documento.1"),
        F.date_format("o_orderdate", "d/M/yyyy").alias("Fecha de nacimiento"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "autismo leve")
        .when(F.col("o_orderpriority") == "2-HIGH", " Ninguna ")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "baja vision")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "asma")
        .otherwise("nan")
        .alias("¿Qué discapacidad tiene?"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("Folio"),
    )
    return enrolment_request(form, "2025-06-30", tiebreak=["Folio"])


# --- curriculum --------------------------------------------------------------------------

_SITES = K.CURRICULUM_SHEETS[2025]


@query(
    f"""SELECT p_type AS "AREA", CASE WHEN p_size % 9 < 5 THEN p_name END AS "TEMAS", p_size::VARCHAR AS "GRADO",
      CASE WHEN p_size % 9 >= 5 THEN p_name END AS "TEMA",
      {sql_choose("p_size % 9", [s.upper().replace("Í", "I") for s in _SITES])} AS "SEDE" FROM part"""
)
def entity_curriculum_progress(spark, sf):
    p = table(spark, sf, "part").withColumn("i", F.col("p_size") % 9)
    sheet = choose(F.col("i"), _SITES)
    sheets = p.select(F.lit("f").alias("file"), sheet.alias("sheet"), "i").distinct()
    values = {0: F.col("p_type"), 1: F.col("p_name"), 2: F.col("p_size"), 3: F.lit("se quita")}
    cells = workbook(
        *[
            title_cells(sheets.filter("i < 5"), 0, {0: "Área ", 1: "Temas", 2: "Grado", 3: "Capacidad"}),
            title_cells(sheets.filter("i >= 5"), 0, {0: "AREA", 1: "Tema", 2: "GRADO", 3: "Capacidad"}),
            row_cells(p, "f", sheet, F.col("p_partkey") + 1, values),
            row_cells(p, "f", "Resumen", F.col("p_partkey") + 1, values),
        ]
    )
    return curriculum_progress(cells, _SITES)


# --- timetable hours ---------------------------------------------------------------------


@query(
    """WITH p AS (SELECT p_partkey // 50 AS f, p_partkey % 50 AS r, p_partkey AS k, p_type, p_size, p_brand FROM part),
    b AS (SELECT *, first_value(label IGNORE NULLS) OVER (PARTITION BY f ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS site
      FROM (SELECT *, CASE WHEN r % 6 = 5 THEN ['VENTANILLA', 'PUENTE PIEDRA', 'CUSCO', 'HUANCAVELICA', 'HUAROCHIRÍ', 'VMT - PARAISO'][k % 6 + 1] END AS label FROM p)),
    h AS (SELECT site, p_type AS area, ciclo, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE (p_size + extra)::DOUBLE END AS horas, grados
      FROM b, (VALUES ('CICLO_II', 0, ['INICIAL']), ('CICLO_III', 1, ['1ER GRADO', '2DO GRADO']),
        ('CICLO_IV', 2, ['3ER GRADO', '4TO GRADO']), ('CICLO_V', 3, ['MULTIGRADO'])) c(ciclo, extra, grados)
      WHERE label IS NULL AND site IS NOT NULL),
    x AS (SELECT unnest(CASE site WHEN 'VENTANILLA' THEN ['01 PACHACUTEC', '02 HDMP', '03 SANTA ROSA'] WHEN 'PUENTE PIEDRA' THEN ['04 PTE. PIEDRA']
        WHEN 'CUSCO' THEN ['05 CUSCO'] WHEN 'HUANCAVELICA' THEN ['06 HUANCAVELICA'] WHEN 'HUAROCHIRÍ' THEN ['07 HUAROCHIRI']
        ELSE ['08 VMT PARAISO'] END) AS sede, area, ciclo, horas AS horas_semanales, grado_detalle
      FROM (SELECT site, area, ciclo, horas, unnest(grados) AS grado_detalle FROM h WHERE horas IS NOT NULL)),
    t AS (SELECT *, sum(horas_semanales) OVER (PARTITION BY sede, grado_detalle) AS total_horas_semanales FROM x)
    SELECT *, 8 AS semanas_prom_bimestre, total_horas_semanales * 8 AS total_horas_bimestre,
      (CASE WHEN sede < '04' THEN 4.0 ELSE 4.5 END)::DOUBLE AS bimestres_anio, 0 AS extra_horas_anio,
      total_horas_semanales * 8 * (CASE WHEN sede < '04' THEN 4.0 ELSE 4.5 END)::DOUBLE AS total_horas_anio, 2025 AS "ANIO" FROM t"""
)
def entity_timetable_hours(spark, sf):
    """Workbooks of fifty lines: hour lines, and a site's name below its lines."""
    p = table(spark, sf, "part").selectExpr(
        "p_partkey div 50 as f", "p_partkey % 50 as r", "p_partkey as k", "p_type", "p_size", "p_brand"
    )
    name, sheet = F.concat(F.lit("horario "), F.col("f").cast("string")), K.HOURS_SHEET
    label = F.when(F.col("r") % 6 == 5, choose(F.col("k") % 6, K.HOURS_SITES))
    hours = F.when(F.col("p_brand") == "Brand#1", "por definir")
    lines = {1: F.coalesce(label, F.concat(F.lit(K.HOURS_PREFIX + " | "), "p_type"))}
    for i in range(4):
        lines[2 + i] = F.when(label.isNull(), F.coalesce(hours, (F.col("p_size") + i).cast("string")))
    variables = {1: "VARIABLES", 2: "INICIAL", 3: "1ER Y 2DO GRADO", 4: "3ER Y 4TO GRADO", 5: "Multigrado"}
    files = p.select(name.alias("file"), F.lit(sheet).alias("sheet")).distinct()
    cells = workbook(
        *[
            title_cells(files, 2, {1: "VARIABLES", 2: "se descarta"}),
            title_cells(files, 5, variables),
            title_cells(files, 65, {1: "CUSCO"}),
            row_cells(p, name, sheet, F.col("r") + 6, lines),
        ]
    )
    return timetable_hours(cells, 2025)


# --- experiential activities -------------------------------------------------------------


@query(
    """WITH e AS (SELECT user_id, user_id % 4 AS f, ts::DATE AS d, event_type FROM events),
    u AS (SELECT f, user_id, count(*) AS n, count(DISTINCT d) AS k FROM e GROUP BY 1, 2), dd AS (SELECT DISTINCT f, d FROM e),
    m AS (SELECT user_id, d, min(event_type) AS mark FROM e GROUP BY 1, 2)
    SELECT '7' || user_id AS "DNI", 'Niño ' || user_id AS "NOMBRES Y APELLIDOS", '2DO' AS "GRADO", NULL::VARCHAR AS "SEXO",
      'Centro ' || f AS "CENTRO", 'ACTIVO' AS "ESTADO", n::DOUBLE AS "ASISTENCIAS PROGRAMADAS", k::DOUBLE AS "ASISTENCIAS REALES",
      k / n::DOUBLE AS "% PART.", CASE WHEN k > 20 THEN 'REGULAR' END AS "CONDICIÓN DE PARTICIPACIÓN", mark AS "VALOR", d AS "FECHA",
      CASE WHEN day(d) < 20 THEN 'Visita - día ' || day(d) END AS "ACTIVIDAD", monthname(d) AS "MES"
    FROM u JOIN dd USING (f) LEFT JOIN m USING (user_id, d)"""
)
def entity_experiential_attendance(spark, sf):
    e = table(spark, sf, "events").selectExpr("user_id", "user_id % 4 as f", "cast(ts as date) as d", "event_type")
    name, sheet = F.concat(F.lit("vivenciales "), "f"), K.EXPERIENTIAL_SHEET
    day = F.datediff(F.col("d"), F.lit("2024-01-01").cast("date"))
    children = e.groupBy("f", "user_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("d").alias("k"))
    last = e.groupBy("f").agg(F.max(day).alias("last"))
    days = e.select("f", "d").distinct()
    marks = e.groupBy("f", "user_id", "d").agg(F.min("event_type").alias("mark"))
    files = last.select(name.alias("file"), F.lit(sheet).alias("sheet"))
    activity = F.when(F.dayofmonth("d") < 20, F.concat(F.lit("Visita - día "), F.dayofmonth("d").cast("string")))
    row, at = F.col("user_id") + 6, 7 + F.col("last")
    totals = children.join(last, "f")
    tail = [F.col("n"), F.col("k"), F.col("k") / F.col("n"), F.when(F.col("k") > 20, "REGULAR")]
    cells = workbook(
        *[
            title_cells(files, 0, {1: "REGISTRO"}),
            single_cells(days, name, sheet, 2, 7 + day, activity),
            single_cells(days, name, sheet, 3, 7 + day, mixed_date(F.col("d"), day % 3)),
            title_cells(files, 4, {1: "DNI", 2: "NOMBRES"}),
            title_cells(files, 5, {1: "(texto)"}),
            *[single_cells(last, name, sheet, 4, at + 1 + i, F.lit(t)) for i, t in enumerate(K.EXPERIENTIAL_TOTALS)],
            row_cells(
                children,
                name,
                sheet,
                row,
                {
                    0: F.lit("1"),
                    1: F.concat(F.lit("7"), "user_id", F.lit(".0")),
                    2: F.concat(F.lit("Niño "), "user_id"),
                    3: F.lit("2DO"),
                    5: F.concat(F.lit("Centro "), "f"),
                    6: F.lit("ACTIVO"),
                },
            ),
            single_cells(marks, name, sheet, row, 7 + day, F.col("mark")),
            *[single_cells(totals, name, sheet, row, at + 1 + i, v) for i, v in enumerate(tail)],
            single_cells(last, name, sheet, 40_000_000, at, F.lit("total")),
        ]
    )
    return experiential_attendance(cells, 2024)


# --- skills ------------------------------------------------------------------------------


@query(
    """WITH c AS (SELECT *, c_nationkey % 3 AS i FROM customer), x AS (
      SELECT *, 'LB' AS esc, CASE c_mktsegment WHEN 'BUILDING' THEN 'En Inicio' WHEN 'MACHINERY' THEN 'LOGRADO' WHEN 'HOUSEHOLD' THEN 'Otro' END AS nivel FROM c
      UNION ALL SELECT *, 'LS', CASE WHEN c_acctbal > 5000 THEN 'Sobresaliénte' WHEN c_acctbal > 0 THEN 'en proceso' END FROM c)
    SELECT (c_custkey + 1)::VARCHAR AS "DNI__c", c_name AS "Apellidos_y_nombres__c", NULL::VARCHAR AS "Grado__c", NULL::VARCHAR AS "Sexo__c",
      'N' || c_nationkey AS "Centro__c", NULL::VARCHAR AS "Permanencia__c", 'Activo' AS "Condicin_actual__c",
      CASE WHEN c_acctbal > 2000 THEN 'Propia' ELSE ['Autogestión', 'Sociales', 'Investigación'][i + 1] END AS "Habilidades__c",
      esc AS "Escenario", nivel AS "Nivel_de_logro__c", CASE nivel WHEN 'En Inicio' THEN 1 WHEN 'en proceso' THEN 2 WHEN 'LOGRADO' THEN 3
        WHEN 'Sobresaliénte' THEN 4 END AS "Nivel_logroOrden", CASE esc WHEN 'LB' THEN '2025-I' ELSE '2025-II' END AS "Evaluacion__c"
    FROM x WHERE nivel IS NOT NULL"""
)
def entity_skills(spark, sf):
    c = table(spark, sf, "customer").withColumn("i", F.col("c_nationkey") % 3)
    sheet = choose(F.col("i"), list(K.SKILL_SHEETS))
    sheets = c.select(F.lit("f").alias("file"), sheet.alias("sheet")).distinct()
    titles = {
        0: "N°", 1: "DNI", 2: "Apellidos y nombres", 3: "Centro", 4: "Condición actual", 5: "Habilidades",
        6: "Nivel de logro Base", 7: "Nivel de logro Salida ",
    }
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    base = F.when(segment == "BUILDING", "En Inicio").when(segment == "MACHINERY", "LOGRADO").when(segment == "HOUSEHOLD", "Otro")
    values = {
        0: F.col("c_custkey"),
        1: (F.col("c_custkey") + 1).cast("string"),
        2: F.col("c_name"),
        3: F.concat(F.lit("N"), "c_nationkey"),
        4: F.lit("Activo"),
        5: F.when(balance > 2000, "Propia"),
        6: base,
        7: F.when(balance > 5000, "Sobresaliénte").when(balance > 0, "en proceso"),
    }
    cells = workbook(title_cells(sheets, 0, titles), row_cells(c, "f", sheet, F.col("c_custkey") + 1, values))
    return skills(cells, 2025)
