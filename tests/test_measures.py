import datetime as dt

import pytest
from pyspark.sql import functions as F

from aulario.operators import measures as M
from aulario.operators.measures import FilterContext
from aulario.plans import constants as K
from aulario.plans import dashboard as D
from aulario.plans.dashboard import Settings
from tests.conftest import rows

ATT = (
    "DNI__c string, FECHA__c date, ASISTENCIA__c string, TIPO_ALUMNO__c string, A_REALES__c double, "
    "A_ESPERADAS__c double, F_INCORPORACION__c date, CENTRO__c string"
)


def day(n, month=3):
    return dt.date(2025, month, n)


@pytest.fixture(scope="module")
def attendance(spark):
    data = [
        ("1", day(1), "A", "ACTIVO", 8.0, 10.0, day(1, 1), "X"),
        ("1", day(2), "F", "ACTIVO", 8.0, 10.0, day(1, 1), "X"),
        ("2", day(1), "A", "ACTIVO", 5.0, 10.0, day(5, 3), "X"),
        ("2", day(3), "FJ", "INACTIVO", 5.0, 10.0, day(5, 3), "Y"),
        ("3", day(20, 2), "A", "INACTIVO", 0.0, 0.0, day(9, 3), "Y"),
        (None, day(2), "F", None, None, None, None, "Y"),
    ]
    return spark.createDataFrame(data, ATT)


def one(df):
    return df.first().asDict()


def test_catalogue_has_every_measure():
    expected = {f"1.{i}" for i in range(1, 12)} | {f"2.{i}" for i in range(1, 17)} | {f"3.{i}" for i in range(1, 18)}
    expected |= {f"4.{i}" for i in range(1, 19)} | {f"5.{i}" for i in range(1, 10)} | {f"6.{i}" for i in range(1, 6)}
    expected |= {f"7.{i}" for i in range(1, 21)} | {"8.1", "8.4"}
    assert set(D.MEASURES) == expected


def test_counts_and_blanks(attendance):
    t = {"attendance": attendance, "extra": attendance.limit(0), "social": attendance.limit(0), "skills": None}
    assert one(D.measure("1.1", t)) == {"attendances": 3}
    assert one(D.measure("1.2", t)) == {"extra_attendances": None}
    assert one(D.measure("2.6", t)) == {"children_in_social_record": 0}
    assert one(D.measure("2.4", t)) == {"extra_children_total": 0}
    assert one(D.measure("1.11", t)) == {"class_days": 4}


def test_distinct_counts_treat_null_as_a_value(attendance):
    got = one(M.distinct_counts(attendance, FilterContext(), "DNI__c", n=F.lit(True)))
    without = one(M.distinct_counts(attendance, FilterContext(), "DNI__c", count_null=False, n=F.lit(True)))
    assert (got["n"], without["n"]) == (4, 3)


def test_children_and_retention(attendance):
    got = one(D.children({"attendance": attendance}, FilterContext(), Settings()))
    assert got["children_total"] == 3 and got["active_children"] == 2 and got["inactive_children"] == 2
    assert got["retention_rate"] == pytest.approx(2 / 3)
    empty = one(D.children({"attendance": attendance.limit(0)}, FilterContext(), Settings()))
    assert empty == {"children_total": 0, "active_children": None, "inactive_children": None, "retention_rate": None, "dropout_rate": None}


def test_cut_offs_ignore_the_date_filter_and_grow(attendance):
    ctx = FilterContext(filters={"FECHA__c": lambda c: c > day(1, 6)})
    seen = []
    for cut in (None, day(19, 2), day(20, 2), day(1), day(30)):
        s = Settings(cuts={1: cut, 2: cut})
        seen.append(one(D.measure("7.3", {"attendance": attendance}, ctx, s))["impacted_cut1"] or 0)
        counted = one(D.measure("1.3", {"attendance": attendance}, ctx, s))["attended_cut1"] or 0
        assert counted <= 3
    assert seen == [0, 0, 1, 3, 3]


def test_mean_ratio_ignores_filters_but_the_child(attendance):
    t = {"attendance": attendance}
    assert one(D.measure("1.8", t))["mean_attendance"] == pytest.approx((0.8 + 0.5) / 2)
    per_centre = {r[0]: r[1] for r in D.measure("1.8", t, FilterContext(by=("CENTRO__c",))).collect()}
    assert per_centre["X"] == pytest.approx(0.65) and per_centre["Y"] == pytest.approx(0.5)
    only_day = FilterContext(filters={"FECHA__c": lambda c: c == day(2)})
    assert one(D.measure("1.8", t, only_day))["mean_attendance"] == pytest.approx(0.8)


def test_absence_rates_skip_children_without_any(attendance):
    got = one(D.absence_means({"attendance": attendance}, FilterContext(), Settings()))
    assert got["absence_rate"] == pytest.approx(0.1) and got["excused_rate"] == pytest.approx(0.1)


def test_first_dates_and_current_month(attendance):
    t = {"attendance": attendance}
    dates = {r["DNI__c"]: (r["activation_date"], r["dropout_date"]) for r in D.status_dates(t, FilterContext(), Settings()).collect()}
    assert dates["2"] == (day(1), day(3)) and dates["3"] == (None, day(20, 2)) and dates[None] == (None, None)
    got = one(D.month_changes(t, FilterContext(), Settings()))
    assert got == {"new_active": 2, "new_inactive": 1, "impacted_in_month": 3}
    february = FilterContext(filters={"FECHA__c": lambda c: c < day(1)})
    assert one(D.month_changes(t, february, Settings())) == {"new_active": None, "new_inactive": 1, "impacted_in_month": 1}


def test_last_month_cohort(attendance):
    assert one(D.measure("2.7", {"attendance": attendance})) == {"joined_last_month": 2}
    ctx = FilterContext(filters={"DNI__c": lambda c: c == "1"})
    assert one(D.measure("2.7", {"attendance": attendance}, ctx)) == {"joined_last_month": None}


def test_single_value_keys(spark):
    df = spark.createDataFrame([("1", "SÍ"), ("1", "SÍ"), ("2", "SÍ"), ("2", None), ("3", "NO"), (None, "SÍ")], "k string, v string")
    assert one(M.keys_with_single_value(df, FilterContext(), "k", "v", "SÍ", "n")) == {"n": 2}


def test_shares(spark):
    df = spark.createDataFrame(
        [("1", "A", "X"), ("1", "B", "X"), ("2", "A", "X"), ("3", "B", "Y")], "DNI__c string, NIVEL_DE_LOGRO__c string, g string"
    )
    level = "NIVEL_DE_LOGRO__c"
    got = {(r["g"], r[level]): r["level_share"] for r in D.measure("3.3", {"grades": df}, FilterContext(by=("g",))).collect()}
    assert got == {("X", "A"): 1.0, ("X", "B"): 0.5, ("Y", "B"): 1.0}
    ctx = FilterContext(filters={level: lambda c: c == "A", "g": lambda c: c == "X"})
    labels = rows(D.measure("8.1", {"grades": df}, ctx), level, "level_label")
    assert labels == [("A", "100.0%  (2 niños)")]
    assert one(D.measure("3.2", {"grades": df}, ctx)) == {"evaluated_overall": 3}


def test_rows_share_and_kept_filters(spark):
    df = spark.createDataFrame(
        [("X", "M", "i", "p"), ("X", "M", "i", "q"), ("X", "M", "f", "p")],
        "CENTRO__c string, AREA__c string, STATUS__c string, DOCENTE string",
    )
    ctx = FilterContext(("CENTRO__c",), {"DOCENTE": lambda c: c == "p"})
    assert rows(D.measure("3.17", {"curriculum": df}, ctx)) == [("X", "2 (66.7%)")]
    kept = FilterContext(("CENTRO__c",), {"STATUS__c": lambda c: c == "i", "DOCENTE": lambda c: c == "p"})
    assert rows(D.measure("3.17", {"curriculum": df}, kept)) == [("X", "1 (50.0%)")]


def test_topics_need_a_single_area(spark):
    df = spark.createDataFrame([("M", "t1"), ("M", "t2"), ("C", "t1"), ("M", None)], "AREA__c string, TEMAS__c string")
    assert one(D.measure("3.16", {"curriculum": df})) == {"topics_in_area": None}
    ctx = FilterContext(filters={"AREA__c": lambda c: c == "M"})
    assert one(D.measure("3.16", {"curriculum": df}, ctx)) == {"topics_in_area": 3}


def test_answers_and_levels(spark):
    df = spark.createDataFrame([("DE ACUERDO",), ("MUY EN DESACUERDO",), (None,), ("SIEMPRE",)], "P1 string")
    s = Settings(questions={"P1": "uno"}, question="uno", scales=(K.AGREEMENT, {"SIEMPRE": 4}))
    got = rows(D.answers({"survey": df}, FilterContext(), s), "answer_level", "answer_legend", "unified_level")
    assert got == sorted(
        [(3, "DE ACUERDO", 3), (1, "MUY EN DESACUERDO", 1), (None, "Sin respuesta", None), (None, "SIEMPRE", 4)], key=repr
    )
    from dataclasses import replace

    at_three = D.measure("4.15", {"survey": df}, settings=replace(s, legend_level=3))
    assert rows(at_three, "answers_at_level") == [(1,)]


def test_indicator_shares_are_blank_without_the_answer(spark):
    df = spark.createDataFrame([(1,), (3,), (None,), (3,)], "Indicador_4__c int")
    got = one(D.indicator_shares({"indicators": df}, FilterContext(), Settings()))
    assert got["indicator_share_1"] == pytest.approx(1 / 3) and got["indicator_share_4"] is None


def test_hours_for_selected_centre(spark):
    hours = spark.createDataFrame([("X", 2.0), ("Y", 3.0), ("Z", 5.0)], "Nombre_Limpio string, Valor double")
    att = spark.createDataFrame([("X",), ("X",), ("Y",)], "Centro_Limpio string")
    t = {"hours": hours, "attendance": att}
    assert one(D.measure("6.5", t))["learning_hours_selected"] == 10.0
    ctx = FilterContext(filters={"Centro_Limpio": lambda c: c == "Y"})
    assert one(D.measure("6.5", t, ctx))["learning_hours_selected"] == 3.0
    assert rows(D.hours_by_centre(t, FilterContext(), Settings())) == [("X", 2.0), ("Y", 3.0)]


def test_slicer_and_changes(attendance):
    s = Settings(cuts={1: day(20, 2), 2: day(30)}, slicer_row=K.SLICER_ROWS["inactivos"])
    got = one(D.slicer_regular({"attendance": attendance}, FilterContext(), s))
    assert (got["value_cut1"], got["value_cut2"], got["change_12"]) == (1, 2, 1.0)


def test_parts_add_up_to_the_whole(attendance):
    whole = one(D.measure("1.1", {"attendance": attendance}))["attendances"]
    parts = D.measure("1.1", {"attendance": attendance}, FilterContext(by=("CENTRO__c",))).collect()
    assert sum(r["attendances"] for r in parts) == whole


def test_long_form_and_kpis(attendance):
    t = {"attendance": attendance}
    long = {r["number"]: r["value"] for r in D.evaluate(["1.1", "2.1", "2.13"], t).collect()}
    assert long["1.1"] == "3" and long["2.1"] == "3"
    kpi = {r["kpi"]: r["reached"] for r in D.kpi_report(t).collect()}
    assert kpi == {"children_total": False, "retention_rate": False, "mean_attendance": False}


def test_every_measure_can_be_evaluated(spark, attendance):
    s = Settings(cuts={c: day(c) for c in (1, 2, 3, 4)}, questions={"P1": "uno"}, question="uno", improved_school="P1", learned_by_playing="P1")

    def one_row(schema, *values):
        return spark.createDataFrame([values], schema)

    tables = {
        "attendance": attendance.withColumn("Centro_Limpio", F.col("CENTRO__c")),
        "extra": attendance,
        "grades": one_row(
            "DNI__c string, REA__c string, NIVEL_DE_LOGRO__c string, Valor_Promedio__c double, EVALUACION__c string, Competencia_texto__c string",
            "1", "Comunicación", "A", 12.5, "2025-I", "Lee",
        ),
        "curriculum": one_row(
            "AREA__c string, TEMAS__c string, CENTRO__c string, STATUS__c string, CICLO__c string, BIMESTRE__c string",
            "M", "t", "X", "s", "c", "b",
        ),
        "survey": one_row("N_de_documento__c string, N_de_documento_1__c string, P1 string", "1", "2", "DE ACUERDO"),
        "children_satisfaction": one_row(", ".join(f"Pregunta_{i} double" for i in range(1, 6)), 1.0, 2.0, 3.0, 4.0, None),
        "indicators": one_row("Indicador_4__c int", 3),
        "requests": one_row("Nmero_de_Documento__c string, Cuenta_con_algn_tipo_de_discapacidad__c string", "1", "SÍ"),
        "social": one_row("Nmero_de_Documento__c string", "1"),
        "guardians": one_row("Apoderado_DNI__c string", "1"),
        "workshops": one_row("DNI string", "1"),
        "skills": one_row("DNI__c string, Nivel_de_logro__c string", "1", "Logrado"),
        "experiential": one_row("DNI__c string, FECHA__c date, ACTIVIDAD__c string, VALOR__c string", "1", day(1), "v", "A"),
        "hours": one_row("Nombre_Limpio string, Valor double", "PACHACÚTEC", 7.0),
    }
    for number in D.MEASURES:
        assert D.measure(number, tables, settings=s).columns
    # In long form, one branch per block.
    numbers = [n for n in D.MEASURES if not n.startswith(("1.", "2.", "7."))]
    got = {r["number"]: r["value"] for r in D.evaluate(numbers, tables, settings=s).collect()}
    assert set(got) == set(numbers)
    assert got["8.4"] == "Ú" and got["3.6"] == "12.5" and got["4.8"] == "1 (100.0%)" and got["5.6"] == "100.0%  (1 niños)"
    assert got["4.5"] is None and got["6.3"] == "1" and got["4.17"] == "1.0"
