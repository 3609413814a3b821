"""The file side: scans, exports and load tables, written and read back over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aulario.operators.combine import union_years
from aulario.plans.attendance import regular_attendance
from aulario.plans.load import prepare_load
from aulario.queries import entities as E
from aulario.queries.register import Registry, table
from aulario.sources import readers, sinks
from aulario.sources.stages import stage_folder

REGISTRY = Registry()
query = REGISTRY.query


def folder(spark, label: str) -> str:
    return f"{stage_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _customer_cells(spark, sf):
    """Two cells per customer in a sheet per nation."""
    c = table(spark, sf, "customer").select(
        F.lit("01 X - r.xlsx").alias("file"),
        F.concat(F.lit("N"), "c_nationkey").alias("sheet"),
        (F.col("c_custkey") + 1).cast("int").alias("row"),
        F.array(
            F.struct(F.lit(0).alias("col"), F.col("c_name").alias("value")),
            F.struct(F.lit(1).alias("col"), F.col("c_mktsegment").alias("value")),
        ).alias("cells"),
    )
    return c.select("file", "sheet", "row", F.inline("cells"))


_CELLS = """(SELECT 'N' || c_nationkey AS sheet, (c_custkey + 1)::INTEGER AS row, 0 AS col, c_name AS value FROM customer
    UNION ALL SELECT 'N' || c_nationkey, (c_custkey + 1)::INTEGER, 1, c_mktsegment FROM customer)"""


@query(
    f"""SELECT CASE WHEN row % 2 = 0 THEN '2025/' ELSE '2026/' END || '01 X - r.xlsx' AS file, sheet, row, col, value
    FROM {_CELLS}"""
)
def scan_two_years(spark, sf):
    """Workbooks of one name in two year folders stay two workbooks."""
    base, cells = folder(spark, "cells"), _customer_cells(spark, sf)
    for year, odd in (("2025", 0), ("2026", 1)):
        cells.filter(F.col("row") % 2 == odd).write.parquet(f"{base}/{year}")
    return readers.scan_cells(spark, [f"{base}/2025", f"{base}/2026"])


@query(
    f"""SELECT CASE WHEN row % 3 = 0 THEN '01 X - r.xlsx' ELSE 'part' END AS file, sheet, row, col, value FROM {_CELLS}"""
)
def scan_mixed_layouts(spark, sf):
    """CSV files in one folder with the columns in another order, and without a file column."""
    base, cells = folder(spark, "cells"), _customer_cells(spark, sf)
    writer = {0: ("file", "sheet", "row", "col", "value"), 1: ("value", "col", "row", "sheet"), 2: ("sheet", "row", "col", "value")}
    for rest, columns in writer.items():
        part = cells.filter(F.col("row") % 3 == rest).select(*columns)
        part.write.mode("append").option("header", True).option("escape", '"').csv(base)
    found = readers.scan_cells(spark, base, "csv")
    return found.withColumn("file", F.when(F.col("file").startswith("part-"), "part").otherwise(F.col("file")))


_TOLD = f"""SELECT (CASE WHEN row % 2 = 0 THEN '{{0}}' ELSE '{{1}}' END) || '/01 X - r.xlsx' AS file, sheet, row, col, value FROM {_CELLS}"""


def _two_folders(spark, sf, *names):
    base, cells = folder(spark, "cells"), _customer_cells(spark, sf)
    for odd, name in enumerate(names):
        cells.filter(F.col("row") % 2 == odd).write.parquet(f"{base}/{name}")
    return base


@query(_TOLD.format("2025.parquet", "2026.parquet"))
def scan_dotted_folders(spark, sf):
    """Year folders whose names look like files."""
    base = _two_folders(spark, sf, "2025.parquet", "2026.parquet")
    return readers.scan_cells(spark, [f"{base}/2025.parquet", f"{base}/2026.parquet"])


@query(_TOLD.format("year=2025", "year=2026"))
def scan_year_partitions(spark, sf):
    """Years as partition folders below one path."""
    return readers.scan_cells(spark, _two_folders(spark, sf, "year=2025", "year=2026"))


@query(_TOLD.format("a/2025", "b c/2025"))
def scan_folder_pattern(spark, sf):
    """Folders found by a pattern."""
    return readers.scan_cells(spark, _two_folders(spark, sf, "a/2025", "b c/2025") + "/*/*")


_QUOTED = """CASE c_custkey % 4 WHEN 0 THEN c_name || chr(10) || c_mktsegment WHEN 1 THEN 'dice "' || c_name || '", ' || c_mktsegment
    WHEN 2 THEN chr(10) || '"' || c_name || '"' || chr(10) ELSE c_name END"""


def _quoted(name: str = "c_name"):
    k, segment, line = F.col("c_custkey") % 4, F.col("c_mktsegment"), F.lit("\n")
    return (
        F.when(k == 0, F.concat(name, line, segment))
        .when(k == 1, F.concat(F.lit('dice "'), name, F.lit('", '), segment))
        .when(k == 2, F.concat(line, F.lit('"'), name, F.lit('"'), line))
        .otherwise(F.col(name))
    )


@query(f"""SELECT 'w.xlsx' AS file, 'Hoja' || chr(10) || '"1"' AS sheet, c_custkey::INTEGER AS row, 0 AS col, {_QUOTED} AS value FROM customer""")
def scan_quoted_cells(spark, sf):
    """Grid cells with line breaks, commas and doubled quotes, in files read in many splits."""
    base = folder(spark, "cells")
    cells = table(spark, sf, "customer").select(
        F.lit("w.xlsx").alias("file"), F.lit('Hoja\n"1"').alias("sheet"), F.col("c_custkey").alias("row"), F.lit(0).alias("col"), _quoted().alias("value")
    )
    sinks.export_csv(cells, base)
    return readers.scan_cells(spark, base, "csv")


@query(f"""SELECT lpad(c_custkey::VARCHAR, 8, '0') AS id, {_QUOTED} AS "¿Qué dijo?
(con comas, y ""comillas"")", CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segmento FROM customer""")
def scan_quoted_text(spark, sf):
    """Form answers with line breaks, under headings with line breaks, in two layouts."""
    base = folder(spark, "csv")
    c = table(spark, sf, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("id"),
        _quoted().alias('¿Qué dijo?\n(con comas, y "comillas")'),
        F.col("c_mktsegment").alias("segmento"),
    )
    sinks.export_csv(c.filter("int(id) % 2 = 0"), f"{base}/a")
    sinks.export_csv(c.filter("int(id) % 2 = 1").drop("segmento"), f"{base}/b")
    return readers.scan_text_csv(spark, [f"{base}/a", f"{base}/b"])


@query(f"SELECT '01 X - r.xlsx' AS file, sheet, row, col, value FROM {_CELLS}")
def scan_wide_layouts(spark, sf):
    """CSV files with needed columns in sixth place and later, and headings in another case."""
    base, cells = folder(spark, "cells"), _customer_cells(spark, sf)
    cells = cells.withColumn("id", F.lit("x, y")).withColumn("nota", F.lit(None).cast("string"))
    writer = {
        0: ("id", "file", "sheet", "row", "col", "value"),
        1: ("VALUE", "Id", "Nota", "File", "Sheet", "Row", "Col"),
        2: ("File", "sheet", "ROW", "col", "Value"),
    }
    for rest, columns in writer.items():
        part = cells.filter(F.col("row") % 3 == rest).select(*[F.col(c).alias(c) for c in columns])
        part.write.mode("append").option("header", True).csv(base)
    return readers.scan_cells(spark, base, "csv")


@query(
    f"""SELECT CASE WHEN row % 2 = 0 THEN '01 X - r.xlsx' ELSE 'part' END AS file, sheet, row, col, value FROM {_CELLS}"""
)
def scan_parquet_without_file(spark, sf):
    """Parquet grids with and without the file column in one folder; no row is lost."""
    base, cells = folder(spark, "cells"), _customer_cells(spark, sf)
    cells.filter("row % 2 = 0").write.parquet(base)
    cells.filter("row % 2 = 1").drop("file").write.mode("append").parquet(base)
    found = readers.scan_cells(spark, base)
    return found.withColumn("file", F.when(F.col("file").startswith("part-"), "part").otherwise(F.col("file")))


@query(
    """SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS id, o_orderpriority || ', "x"' AS respuesta,
      CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS estado FROM orders"""
)
def scan_text_csv(spark, sf):
    """Answers exported in two layouts: ids keep their zeros, absent columns are null."""
    base = folder(spark, "csv")
    o = table(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("id"),
        F.concat("o_orderpriority", F.lit(', "x"')).alias("respuesta"),
        F.col("o_orderstatus").alias("estado"),
    )
    sinks.export_csv(o.filter("estado = 'F'").select("estado", "id", "respuesta"), f"{base}/a", quote_all=True)
    sinks.export_csv(o.filter("estado <> 'F'").drop("estado"), f"{base}/b")
    return readers.scan_text_csv(spark, [f"{base}/a", f"{base}/b"])


@query(
    """SELECT o_custkey AS k, '2025' AS "ANIO_FUENTE" FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, '2026' FROM orders WHERE o_orderstatus <> 'F'"""
)
def years_present(spark, sf):
    """Two years are there, a third is not."""
    base = folder(spark, "years")
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    sinks.write_stage(o.filter("o_orderstatus = 'F'").select("k"), f"{base}/2025")
    sinks.write_stage(o.filter("o_orderstatus <> 'F'").select("k"), f"{base}/2026")
    return union_years(readers.read_years(spark.read.parquet, {y: f"{base}/{y}" for y in ("2025", "2026", "2027")}))


@query("SELECT c_custkey::VARCHAR AS k, c_name AS nombre, nullif(c_mktsegment, 'BUILDING') AS segmento FROM customer")
def csv_export(spark, sf):
    """An export read back: every field quoted, nulls kept apart from text."""
    path = folder(spark, "export")
    c = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("nombre"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segmento")
    )
    sinks.export_csv(c.withColumnRenamed("c_custkey", "k"), path, quote_all=True)
    found = readers.scan_text_csv(spark, [path])
    return found.withColumn("segmento", F.nullif(F.col("segmento"), F.lit("")))


@query("SELECT count(*) AS registros, sum(c_custkey)::BIGINT AS suma, true AS en_lotes FROM customer WHERE c_custkey % 2 = 1")
def full_refresh(spark, sf):
    """A target written twice holds the second load alone, in batches of at most 1,000 records."""
    path = folder(spark, "load")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.full_refresh(c, path)
    sinks.full_refresh(c.filter("c_custkey % 2 = 1"), path)
    per_file = (
        sinks.read_target(spark, path).groupBy(F.input_file_name().alias("f")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("s")
        )
    )
    return per_file.agg(
        F.sum("n").alias("registros"), F.sum("s").alias("suma"), (F.max("n") <= sinks.RECORDS_PER_BATCH).alias("en_lotes")
    )


_RULES = """list_filter([CASE WHEN c_acctbal < 0 THEN 'saldo negativo' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'segmento cerrado' END],
    lambda e: e IS NOT NULL)"""


def _checked_load(spark, sf, path):
    """Customers of which some are rejected, for one reason or two."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    rules = {"saldo negativo": F.col("c_acctbal") < 0, "segmento cerrado": F.col("c_mktsegment") == "BUILDING"}
    return sinks.full_refresh(c, path, rules=rules, key="c_custkey")


@query(f"""SELECT c_custkey::VARCHAR AS key, len(e) = 0 AS success, array_to_string(e, ' | ') AS errores FROM (SELECT c_custkey, {_RULES} AS e FROM customer)""")
def load_results(spark, sf):
    """The outcome of every record of a load, rejected ones included."""
    found = _checked_load(spark, sf, folder(spark, "load"))
    return found.select("key", "success", F.array_join("errors", " | ").alias("errores"))


@query(f"""SELECT count(*) FILTER (WHERE len(e) = 0) AS inserted, count(*) FILTER (WHERE len(e) > 0) AS failed, count(*) AS total FROM (SELECT {_RULES} AS e FROM customer)""")
def load_results_summary(spark, sf):
    """Inserted and failed records of a load."""
    return sinks.load_summary(_checked_load(spark, sf, folder(spark, "load")))


@query(f"""SELECT array_to_string(e, ' | ') AS error, count(*) AS n FROM (SELECT {_RULES} AS e FROM customer) WHERE len(e) > 0 GROUP BY 1""")
def load_results_errors(spark, sf):
    """Reasons for which records of a load were rejected."""
    return sinks.top_errors(_checked_load(spark, sf, folder(spark, "load")))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def failed_load_keeps_target(spark, sf):
    """A load that fails while it is written leaves the records of the one before."""
    path = folder(spark, "load")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.full_refresh(c.filter("c_custkey % 2 = 0"), path)
    stopped = F.raise_error(F.lit("stopped")).cast("string")
    name = F.when(F.col("c_custkey") == 77, stopped).otherwise(F.col("c_name"))
    try:
        sinks.full_refresh(c.withColumn("c_name", name), path)
    except Exception as error:  # the class differs between a failed task and a failed commit
        if "stopped" not in str(error):
            raise
    else:
        raise AssertionError("the second load was to fail")
    return sinks.read_target(spark, path)


# --- load tables -------------------------------------------------------------------------


def _load(entity: str, columns: str) -> None:
    """Register ``load_<entity>``: an entity's table prepared for its target object."""
    build, sql = E.REGISTRY[f"entity_{entity}"]

    def run(spark, sf):
        return prepare_load(build(spark, sf), entity)

    run.__name__ = f"load_{entity}"
    run.__doc__ = f"{entity} prepared for its target object."
    REGISTRY.query(f"SELECT {columns} FROM ({sql}) entity")(run)


def _suffixed(*names: str) -> str:
    return ", ".join(f'"{n}" AS "{n}__c"' for n in names)


def _iso(source: str, target: str) -> str:
    return f"strftime(\"{source}\", '%Y-%m-%d') AS \"{target}\""


_load(
    "extracurricular_attendance",
    _suffixed("DNI", "NOMBRE", "GRADO", "SEXO", "TIPO_ALUMNO", "ALERTAS_ASISTENCIA", "ASISTENCIA", "A_ESPERADAS", "A_REALES")
    + ", "
    + _suffixed("PORC_PART", "ARCHIVO_ORIGEN", "HOJA_ORIGEN", "TUTOR")
    + ", replace(\"CENTRO\", '_', ' ') AS \"CENTRO__c\", "
    + ", ".join(_iso(c, f"{c}__c") for c in ("F_INCORPORACION", "FECHA", "F_SALIDA")),
)
_load(
    "enrolment",
    """"N" AS "N__c", "DNI" AS "DNI__c", "APELLIDOS Y NOMBRES" AS "APELLIDOS_Y_NOMBRES__c", "GRADO" AS "GRADO__c", "SEXO" AS "SEXO__c",
    "CENTRO" AS "CENTRO__c", "CONDICION ACTUAL" AS "CONDICION_ACTUAL__c", "TELEFONO" AS "TELEFONO__c",
    "HOJA_ORIGEN" AS "HOJA_ORIGEN__c", """
    + _iso("FECHA DE REGISTRO", "FECHA_DE_REGISTRO__c"),
)
_load("grades", "*")
_load(
    "parent_survey",
    _iso("Marca temporal", "Marca_temporal__c")
    + """, "N Documento Apoderado" AS "N_de_documento__c", "N Documento Niño" AS "N_de_documento_1__c",
    "Respuesta" AS "Respuesta__c", "Folio" AS "Folio__c" """,
)
_load(
    "social_record",
    _iso("Marca temporal", "Marca_temporal__c")
    + """, "Número de documento del niño" AS "Nmero_de_documento_del_nio__c", "Parentesco" AS "Parentesco__c",
    "Parentesco_v1" AS "Parentesco_v1__c", "Folio" AS "Folio__c" """,
)
_load(
    "curriculum_progress",
    """"AREA" AS "AREA__c", coalesce("TEMA", "TEMAS") AS "TEMAS__c", "GRADO" AS "GRADOS__c", "SEDE" AS "SEDE__c" """,
)
_load(
    "enrolment_request",
    ", ".join(_iso(a, b) for a, b in (("Marca temporal", "Marca_temporal__c"), ("Fecha de nacimiento", "Fecha_de_nacimiento__c")))
    + """, "Número de Documento" AS "Nmero_de_Documento__c", "Número de Documento.1" AS "Nmero_de_Documento1__c",
    "¿Qué discapacidad tiene?" AS "Qu_discapacidad_tiene__c", "Folio" AS "Folio__c", "EDAD"::DOUBLE AS "EDAD__c" """,
)
_load(
    "timetable_hours",
    _suffixed("sede", "area", "ciclo", "horas_semanales", "grado_detalle", "total_horas_semanales", "semanas_prom_bimestre")
    + ", "
    + _suffixed("total_horas_bimestre", "bimestres_anio", "extra_horas_anio", "total_horas_anio", "ANIO"),
)
_load(
    "experiential_attendance",
    """"DNI" AS "DNI__c", "NOMBRES Y APELLIDOS" AS "NOMBRES_Y_APELLIDOS__c", "GRADO" AS "GRADO__c", "SEXO" AS "SEXO__c",
    "CENTRO" AS "CENTRO__c", "ESTADO" AS "ESTADO__c", "ASISTENCIAS PROGRAMADAS" AS "ASISTENCIAS_PROGRAMADAS__c",
    "ASISTENCIAS REALES" AS "ASISTENCIAS_REALES__c", "% PART." AS "PART__c",
    "CONDICIÓN DE PARTICIPACIÓN" AS "CONDICIN_DE_PARTICIPACIN__c", "VALOR" AS "VALOR__c", "ACTIVIDAD" AS "ACTIVIDAD__c",
    "MES" AS "MES__c", """
    + _iso("FECHA", "FECHA__c"),
)
_load(
    "skills",
    """"DNI__c", "Apellidos_y_nombres__c", "Grado__c", "Sexo__c", "Centro__c", "Permanencia__c", "Condicin_actual__c",
    "Habilidades__c", "Nivel_de_logro__c", "Evaluacion__c" """,
)


@query(
    E._REGULAR
    + """SELECT "DNI" AS "DNI__c", strftime("FECHA", '%Y-%m-%d') AS "FECHA__c", "ASISTENCIA" AS "ASISTENCIA__c",
      CASE WHEN f % 2 = 0 THEN "TUTOR" END AS "TUTOR__c", CASE WHEN f % 2 = 0 THEN '2025' ELSE '2026' END AS "ANIO_FUENTE__c"
    FROM (SELECT *, substr("CENTRO", 2, 1)::INTEGER AS f FROM r)"""
)
def load_differing_years(spark, sf):
    """Two years with differing columns and children, consolidated and prepared."""
    long = regular_attendance(E.regular_cells(spark, sf)).select("DNI", "CENTRO", "FECHA", "ASISTENCIA", "TUTOR")
    even = F.substring("CENTRO", 2, 1).cast("int") % 2 == 0
    years = {"2025": long.filter(even).drop("CENTRO"), "2026": long.filter(~even).drop("CENTRO", "TUTOR")}
    return prepare_load(union_years(years), "regular_attendance")
