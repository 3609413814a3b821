import datetime as dt

import pytest
from pyspark.sql import functions as F

from aulario.plans import constants as K
from aulario.plans.attendance import extracurricular_attendance, regular_attendance
from aulario.plans.curriculum import curriculum_progress
from aulario.plans.enrolment import enrolment
from aulario.plans.experiential import experiential_attendance
from aulario.plans.forms import enrolment_request, parent_survey, social_record
from aulario.plans.grades import equivalences, grades
from aulario.plans.hours import timetable_hours
from aulario.plans.load import SPECS, prepare_load
from aulario.plans.skills import skills
from tests.conftest import rows
from tests.test_grid import CELLS, sheet


def both(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_regular_attendance(spark):
    lines = [[None] * 5 for _ in range(2)] + [["TUTORA:", "Rosa"]] + [[None]] * 3
    head = ["DNI", "NOMBRES", "APELLIDO PATERNO", "GRADO", "SEXO", "TIPO DE ALUMNO", "2025-03-04", "5/3/2025", "E", "R", "%", "obs"]
    lines += [head, ["799.0", "Ana", "Ruiz", "1ER GRADO", "m", "activo", "A", None, "2", "1", "0.5", "z"]]
    lines += [[None, "SIN ID", None, None, None, None, "A"], ["12-3", "Leo", "Paz", None, "nan", None, None, "F"]]
    cells = sheet(spark, lines, "ASISTENCIA 1", "01 SEDE - X.xlsx", first_col=2)
    other = sheet(spark, lines, "Resumen", "01 SEDE - X.xlsx", first_col=2)
    got = regular_attendance(both(cells, other))
    assert got.columns == list(K.ATTENDANCE_COLUMNS)
    assert rows(got, "DNI", "NOMBRE", "CENTRO", "SEXO", "TIPO_ALUMNO", "FECHA", "ASISTENCIA", "A_ESPERADAS", "PORC_PART", "TUTOR") == sorted(
        [
            ("799", "Ruiz, Ana", "01 SEDE", "FEMENINO", "ACTIVO", dt.date(2025, 3, 4), "A", 2.0, 0.5, "Rosa"),
            ("799", "Ruiz, Ana", "01 SEDE", "FEMENINO", "ACTIVO", dt.date(2025, 3, 5), None, 2.0, 0.5, "Rosa"),
            ("123", "Paz, Leo", "01 SEDE", None, None, dt.date(2025, 3, 4), None, None, None, "Rosa"),
            ("123", "Paz, Leo", "01 SEDE", None, None, dt.date(2025, 3, 5), "F", None, None, "Rosa"),
        ],
        key=repr,
    )


def test_name_variants_by_sheet(spark):
    def one(titles, values, name):
        lines = [[None]] * 6 + [["DNI", *titles, "2025-03-04"], ["1", *values, "A"]]
        return sheet(spark, lines, f"asist {name}", first_col=2)

    cells = both(
        one(["APELLIDOS Y NOMBRES"], ["Soto Ruiz, Ana"], "a"),
        one(["APELLIDOS", "NOMBRES"], ["Soto", "Ana"], "b"),
        one(["ALUMNO"], ["Ana S."], "c"),
        one(["APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES"], ["Soto", "Ruiz", "Ana"], "d"),
        one(["APELLIDOS Y NOMBRES"], ["Ana Soto"], "e"),
    )
    assert rows(regular_attendance(cells), "HOJA_ORIGEN", "NOMBRE") == [
        ("asist a", "Soto Ruiz, Ana"),
        ("asist b", "Soto, Ana"),
        ("asist c", "Ana S."),
        ("asist d", "Soto Ruiz, Ana"),
        ("asist e", "Ana Soto"),
    ]


def test_extracurricular_attendance(spark):
    lines = [["título"], ["DNI", "GRADO", "APELLIDOS Y NOMBRES", "SEXO", "45000", "abr"], ["7", "2DO", "Paz,  Leo", "M", "A", "1"]]
    cells = sheet(spark, lines, "lista asist", "TALLERES_SEDE UNO REGISTRO DE ASISTENCIA 2026.xlsx")
    got = extracurricular_attendance(cells, 2026)
    assert rows(got, "DNI", "NOMBRE", "CENTRO", "SEXO", "FECHA", "ASISTENCIA", "A_ESPERADAS") == [
        ("7", "Paz, Leo", "SEDE UNO", "MASCULINO", dt.date(2023, 3, 15), "A", 1.0)
    ]


def test_enrolment_modes(spark):
    head = ["DNI", "GRADO", "CONDICIÓN ACTUAL", "FECHA DE REGISTRO"]
    lines = [[None]] * 4 + [head, ["1.0", "1er grado", "Inactivo", "agosto"], ["DNI 2", *head[1:]], [None, "x", "y", "z"]]
    wider = [[None]] * 4 + [[*head, "EXTRA"], ["3", "otro", "RETIRADO", "2025-03-04", "e"]]
    renamed = [[None]] * 4 + [["DNI", "GRADO", "ESTADO", "FECHA DE REGISTRO"], ["4", None, "activo", "#N/A"], ["5", "x", "otra", "4/3/2025"]]
    cells = both(
        sheet(spark, lines, "01 A", first_col=2), sheet(spark, wider, "02 B", first_col=2), sheet(spark, renamed, "03 C", first_col=2)
    )
    got = enrolment(cells, 2026)
    assert got.columns == ["HOJA_ORIGEN", "DNI", "GRADO", "CONDICION ACTUAL", "FECHA DE REGISTRO", "EXTRA"]
    assert rows(got, "DNI", "GRADO", "CONDICION ACTUAL", "FECHA DE REGISTRO", "EXTRA") == sorted(
        [
            ("1", "PRIMERO", "INACTIVO", dt.date(2026, 8, 1), None),
            ("3", "OTRO", "INACTIVO", dt.date(2025, 3, 4), "e"),
            ("4", None, "ACTIVO", None, None),
            ("5", "X", None, dt.date(2025, 3, 4), None),
        ],
        key=repr,
    )
    by_fragment = enrolment(cells, 2026, exact_status=False)
    assert ("1", "ACTIVO") in rows(by_fragment, "DNI", "CONDICION ACTUAL")


@pytest.mark.parametrize("match,n", [("row", 5), ("id", 21)])
def test_grades_by_row_and_by_id(spark, match, n):
    head = ["DNI", "GRADO", "PERMANENCIA", "PROMEDIO C1", "NIVEL DE LOGRO C1", "PORCENTAJE DE PROMEDIO", "NIVEL DE LOGRO"]
    base = [["t"], head, ["1", "g", "2025", "15", "A", "80%", "B"], ["2", "g", None, "x", "C", None, None], ["2", "h", None, "9", "C", None, None]]
    base += [[None, "total", None, "5", "A"], [None, "total", None, "6", "B"]]
    texts = [[None], [None], ["Área", "Equivalencia", "Competencia"], ["Matemática ", "C1", "Resuelve"], [None, "C2", "nada"]]
    cells = both(sheet(spark, base, "LB_Matemática"), sheet(spark, texts, "Equivalencias Competencias"))
    got = grades(cells, 2025, match=match)
    assert got.count() == (n if match == "row" else 1 + 8 + 8)
    first = [r for r in got.collect() if r["DNI__c"] == "1"][0].asDict()
    assert first["Valor_Promedio__c"] == 15.0 and first["PORCENTAJE_DE_PROMEDIO__c"] == 80.0
    assert first["EVALUACION__c"] == "2025-I" and first["Competencia_texto__c"] == "Resuelve" and first["NIVEL_DE_LOGRO__c"] == "B"
    assert equivalences(cells).count() == 2


@pytest.mark.parametrize("match", ["row", "id"])
def test_every_score_and_level_column_of_a_competence(spark, match):
    head = ["DNI", "PROMEDIO C1", "PROMEDIO C1 RECUPERACION", "NIVEL DE LOGRO C1", "PROMEDIO C2", "NIVEL DE LOGRO C2", "NIVEL DE LOGRO C2 B"]
    cells = sheet(spark, [head, ["1", "10", "15", "A", "7", "B", "C"]], "LB_Matemática")
    texts = spark.createDataFrame([("Matemática", "C1", "t")], "AREA_EVALUACION string, COMPETENCIA string, COMPETENCIA_TEXTO string")
    got = grades(cells, 2025, texts, match=match)
    assert rows(got, "Competencia__c", "Valor_Promedio__c", "Valor_alcanzado__c") == sorted(
        [("C1", 10.0, "A"), ("C1", 15.0, "A"), ("C2", 7.0, "B"), ("C2", 7.0, "C")], key=repr
    )


@pytest.mark.parametrize("match", ["row", "id"])
def test_grades_read_a_cell_once_and_match_whole_records(spark, tmp_path, match):
    head = ["DNI", "PERMANENCIA", *[t for c in range(1, 8) for t in (f"PROMEDIO C{c}", f"NIVEL DE LOGRO C{c}")]]
    lines = [[str(i), "2025", *(["10", "A;  B"] * 7)] for i in range(30)]
    sheet(spark, [head, *lines], "LB_Matemática").write.parquet(str(tmp_path / "cells"))
    texts = spark.createDataFrame([("Matemática", "C1", "t")], "AREA_EVALUACION string, COMPETENCIA string, COMPETENCIA_TEXTO string")
    got = grades(spark.read.parquet(str(tmp_path / "cells")), 2025, texts, match=match)
    assert got.count() == 210 and rows(got.select("Valor_alcanzado__c").distinct()) == [("A B",)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # No array of cells, nor a filter on its size; joins by id lie below the one step that unrolls.
    assert "transform(" not in plan and plan.count("Generate inline") == 1
    assert "_l_salt" not in plan.split("Generate inline")[0]


def test_marks_are_read_after_the_dates_are_unrolled(spark):
    lines = [["título"], ["DNI", "GRADO", "APELLIDOS Y NOMBRES", "SEXO", "45000", "abr"], ["7", "2DO", "Paz,  Leo", "M", "A", "1"]]
    cells = sheet(spark, lines, "lista asist", "TALLERES_SEDE UNO REGISTRO DE ASISTENCIA 2026.xlsx")
    loaded = prepare_load(extracurricular_attendance(cells, 2026), "extracurricular_attendance")
    assert rows(loaded, "DNI__c", "FECHA__c", "ASISTENCIA__c", "A_ESPERADAS__c") == [("7", "2023-03-15", "A", 1.0)]
    after = loaded._jdf.queryExecution().optimizedPlan().toString().split("Generate inline")[0]
    # Dates and doubles are not written out through a zone's timestamp or read again for each mark.
    assert "_cells" in after and "date_format" not in after and "try_cast" not in after


def test_regular_attendance_drops_unused_columns_of_the_range(spark):
    head = ["DNI", "NOMBRES", "2025-03-03", "2025-03-04", "2025-12-01", "E", "", "R", "%"]
    lines = [[None]] * 6 + [head, ["1", "Ana", None, "A", None, "2", None, "1"], ["2", "Leo", None, "F", None, "3", None, "2"]]
    lines[6][6] = "VACIA"
    got = regular_attendance(sheet(spark, lines, "ASISTENCIA", first_col=2))
    # The range ends three columns after the last heading that is a date; unused ones go after that.
    assert rows(got, "DNI", "FECHA", "ASISTENCIA", "A_ESPERADAS", "A_REALES") == [
        ("1", dt.date(2025, 3, 4), "A", 2.0, 1.0),
        ("2", dt.date(2025, 3, 4), "F", 3.0, 2.0),
    ]
    unused = [[None]] * 6 + [["DNI", "NOMBRES", "2025-03-03", "E"], ["1", "Ana", None, "2"]]
    assert regular_attendance(sheet(spark, unused, "ASISTENCIA", first_col=2)).count() == 0


def test_parent_survey(spark):
    data = [
        ("2025-03-04", "12.0", " de acuerdo "),
        ("2025-03-24", "12", "MÚY"),
        (None, "0", "a"),
        ("04/03/2025", None, "b"),
        ("x", "13", "nan"),
    ]
    df = spark.createDataFrame(data, "`Marca temporal` string, `N° de documento` string, `P` string")
    got = parent_survey(df)
    assert got.columns == ["Marca temporal", "N Documento Apoderado", "P"]
    assert ("12", dt.date(2025, 3, 24), "MUY") in rows(got, "N Documento Apoderado", "Marca temporal", "P")
    # Two rows without an id are one guardian; the one without a date wins.
    assert (None, None, "A") in rows(got, "N Documento Apoderado", "Marca temporal", "P")
    assert got.count() == 3


def test_social_record_numbers_repeated_titles(spark):
    df = spark.createDataFrame([("2025-01-01", "1.0", "a", "b"), ("2025-01-02", "1", "c", "d")], ["Marca temporal", K.SOCIAL_KEY, "P", "Q"]).toDF(
        "Marca temporal", K.SOCIAL_KEY, "P", "P"
    )
    got = social_record(df)
    assert got.columns == ["Marca temporal", K.SOCIAL_KEY, "P", "P_v1"]
    assert rows(got, K.SOCIAL_KEY, "P", "P_v1") == [("1", "c", "d")]


def test_enrolment_request(spark):
    data = [
        ("1.0", "2025-01-01", "30/6/2015", "Autismo", "999.0"),
        ("1", None, "1/7/2015", "vista", "x"),
        (None, "2025-01-01", "nada", "nan", None),
        (None, "2025-01-01", None, "ninguna", None),
    ]
    df = spark.createDataFrame(data, f"`{K.REQUEST_KEY}` string, `{K.STAMP}` string, `{K.REQUEST_BIRTH}` string, `{K.DISABILITY}` string, `Número de celular` string")
    got = enrolment_request(df, "2025-06-30")
    assert rows(got, K.REQUEST_KEY, K.DISABILITY, "EDAD", "Número de celular") == sorted(
        [("1", "TEA", 10, "999"), (None, None, None, None), (None, "NINGUNA", None, None)], key=repr
    )


def test_curriculum(spark):
    a = sheet(spark, [["Área", "Temas", "Capacidad"], ["M", "t", "c"]], "05 Cuzco")
    b = sheet(spark, [["AREA", "TEMA"], ["M", "u"]], "08 VMT Paraíso")
    got = curriculum_progress(both(a, b, a.withColumn("sheet", F.lit("otra"))), K.CURRICULUM_SHEETS[2025])
    assert rows(got, "AREA", "TEMAS", "TEMA", "SEDE") == sorted([("M", "t", None, "05 CUZCO"), ("M", None, "u", "08 VMT PARAISO")], key=repr)
    with pytest.raises(ValueError):
        curriculum_progress(a, ["no existe"])
    loaded = prepare_load(got, "curriculum_progress")
    assert rows(loaded, "TEMAS__c", "AREA__c", "SEDE__c") == [("t", "M", "05 CUZCO"), ("u", "M", "08 VMT PARAISO")]


def test_timetable_hours(spark):
    lines = [[None]] * 5 + [
        [None, "VARIABLES", "INICIAL", "1ER Y 2DO GRADO", "Otro", None],
        [None, "N° HORAS SEMANALES | MATEMÁTICA", "2", "3", "x", "9"],
        [None, "VENTANILLA"],
        [None, "N° HORAS SEMANALES | ARTE", "1"],
        [None, "HUAROCHIRÍ"],
        [None, "N° HORAS SEMANALES | SIN SEDE", "1"],
    ]
    got = timetable_hours(sheet(spark, lines, K.HOURS_SHEET), 2025)
    data = rows(got, "sede", "area", "grado_detalle", "horas_semanales", "total_horas_anio")
    assert len(data) == 3 * 3 + 1
    assert ("07 HUAROCHIRI", "ARTE", "INICIAL", 1.0, 36.0) in data
    assert ("02 HDMP", "MATEMATICA", "2DO GRADO", 3.0, 96.0) in data


def test_unmapped_site_has_no_totals(spark):
    from aulario.plans.hours import with_yearly_hours

    df = spark.createDataFrame([(None, "a", "c", 2.0, "g")], "sede string, area string, ciclo string, horas_semanales double, grado_detalle string")
    row = with_yearly_hours(df, 2025).first()
    assert row["total_horas_semanales"] is None and row["semanas_prom_bimestre"] is None and row["ANIO"] == 2025


def test_experiential(spark):
    lines = [
        ["x"],
        [None],
        [None] * 7 + ["Visita", "Taller - dos"],
        [None] * 7 + ["2025-03-04", "5/3/2025", "2024-01-01"],
        ["N", "DNI", "NOMBRES"],
        ["N", "sub"],
        ["1", "77.0", "Ana", "2DO", "F", "Sede", "ACTIVO", "A", None, "A", "4", "3", "0.75", "OK"],
        ["2", None, "sin id", None, None, None, None, "A", "A", "A", "1", "1", "1", "z"],
    ]
    got = experiential_attendance(sheet(spark, lines, K.EXPERIENTIAL_SHEET), 2025)
    assert rows(got, "DNI", "FECHA", "ACTIVIDAD", "MES", "VALOR", "% PART.", "CONDICIÓN DE PARTICIPACIÓN") == sorted(
        [
            ("77", dt.date(2025, 3, 4), "Visita", "March", "A", 0.75, "OK"),
            ("77", dt.date(2025, 3, 5), "Taller - dos", "March", None, 0.75, "OK"),
        ],
        key=repr,
    )
    loaded = prepare_load(got, "experiential_attendance")
    assert {"PART__c", "CONDICIN_DE_PARTICIPACIN__c", "NOMBRES_Y_APELLIDOS__c"} <= set(loaded.columns)
    assert ("2025-03-04",) in rows(loaded, "FECHA__c")


def test_skills(spark):
    head = ["N°", "DNI", "Condición actual", "Habilidades", "Nivel de logro Base", "Nivel de logro Salida"]
    cells = both(
        sheet(spark, [head, ["1", "5", "Activo", None, "EN INICIO", "Logrado "], ["2", None, "x", "y", "z", "w"]], "H_Sociales"),
        sheet(spark, [head, ["1", "6", "Activo", "Propia", None, "raro"]], "H_Autogestión"),
    )
    got = skills(cells, 2026)
    assert rows(got, "DNI__c", "Habilidades__c", "Escenario", "Nivel_logroOrden", "Evaluacion__c") == sorted(
        [("5", "Sociales", "LB", 1, "2026-I"), ("5", "Sociales", "LS", 3, "2026-II"), ("6", "Propia", "LS", None, "2026-II")], key=repr
    )
    assert prepare_load(got, "skills").columns == list(SPECS["skills"].only)


def test_load_preparation(spark):
    df = spark.createDataFrame(
        [("1", "04/03/2025", "x", "TALLERES_A_B REGISTRO DE ASISTENCIA 2025.xlsx", "2025")],
        "DNI string, FECHA string, A_REALES string, CENTRO string, ANIO_FUENTE string",
    )
    got = prepare_load(df, "extracurricular_attendance").first().asDict()
    assert got["FECHA__c"] == "2025-03-04" and got["A_REALES__c"] is None and got["ANIO_FUENTE__c"] == "2025"
    survey = spark.createDataFrame(
        [("2025-03-04", "7", "2", "2025")], "`Marca temporal` string, `N Documento Apoderado` string, `¿Cuántos hijos tienes en el Programa X?` string, ANIO_FUENTE string"
    )
    loaded = prepare_load(survey, "parent_survey")
    assert loaded.columns == ["Marca_temporal__c", "N_de_documento__c", "Cuntos_hijos_tienes_en_el_Programa_X__c"]
    assert tuple(loaded.first()) == ("2025-03-04", "7", 2.0)
    assert set(SPECS) == {
        "regular_attendance", "extracurricular_attendance", "enrolment", "grades", "parent_survey", "social_record",
        "curriculum_progress", "enrolment_request", "timetable_hours", "experiential_attendance", "skills",
    }
