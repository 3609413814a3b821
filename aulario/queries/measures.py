"""Measure-layer queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from aulario.operators import bitmaps
from aulario.operators import measures as M
from aulario.operators.joins import join_lookup
from aulario.operators.measures import FilterContext
from aulario.plans import dashboard as D
from aulario.plans.dashboard import Settings
from aulario.plans.page import evaluate_page
from aulario.queries.register import Registry, cte, fact, table

REGISTRY = Registry()
query = REGISTRY.query

BY_CENTRE = FilterContext(by=("CENTRO__c",))
CUTS = Settings(
    cuts={1: dt.date(2024, 1, 10), 2: dt.date(2024, 1, 20), 3: dt.date(1997, 6, 30), 4: dt.date(1999, 6, 30)},
    questions={"P1": "primera", "P2": "segunda"},
    question="primera",
    scales=(
        {"MUY EN DESACUERDO": 1, "EN DESACUERDO": 2, "DE ACUERDO": 3, "MUY DE ACUERDO": 4},
        {"NUNCA": 1, "A VECES": 2, "CASI SIEMPRE": 3, "SIEMPRE": 4},
    ),
    improved_school="P1",
    learned_by_playing="P2",
)


def rounded(df, *columns, digits=9):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- attendance --------------------------------------------------------------------------


@query(
    cte("attendance")
    + """SELECT CENTRO__c, nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0) AS attendances
    FROM attendance GROUP BY CENTRO__c"""
)
def att_by_centre(spark, sf):
    return D.measure("1.1", {"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)


@query(
    cte("attendance")
    + """SELECT DNI__c, nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0) AS attendances
    FROM attendance GROUP BY DNI__c"""
)
def att_by_user(spark, sf):
    return D.measure("1.1", {"attendance": fact(spark, sf, "attendance")}, FilterContext(by=("DNI__c",)), CUTS)


@query(
    cte("extra")
    + """SELECT CENTRO__c, nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0) AS extra_attendances
    FROM extra WHERE TIPO_ALUMNO__c = 'ACTIVO' GROUP BY CENTRO__c"""
)
def att_filtered(spark, sf):
    ctx = FilterContext(("CENTRO__c",), {"TIPO_ALUMNO__c": lambda c: c == "ACTIVO"})
    return D.measure("1.2", {"extra": fact(spark, sf, "extra")}, ctx, CUTS)


@query(
    cte("attendance")
    + """, c AS (SELECT CENTRO__c,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '2024-01-10'), 0) AS attended_cut1
      FROM attendance GROUP BY CENTRO__c) SELECT * FROM c"""
)
def cum_to_cut_1(spark, sf):
    ctx = FilterContext(("CENTRO__c",), {"FECHA__c": lambda c: c == dt.date(2024, 1, 3)})
    return D.measure("1.3", {"attendance": fact(spark, sf, "attendance")}, ctx, CUTS)


@query(
    cte("attendance")
    + """SELECT CENTRO__c,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '2024-01-20'), 0) AS attended_cut2
      FROM attendance GROUP BY CENTRO__c"""
)
def cum_to_cut_2(spark, sf):
    return D.measure("1.4", {"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)


@query(
    cte("extra")
    + """, c AS (SELECT CENTRO__c,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '1997-06-30'), 0) AS attended_cut3,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '1999-06-30'), 0) AS attended_cut4
      FROM extra GROUP BY CENTRO__c)
    SELECT *, round((coalesce(attended_cut4, 0) - coalesce(attended_cut3, 0)) / nullif(attended_cut3, 0)::DOUBLE, 9)
      AS attended_change_34 FROM c"""
)
def cum_to_cuts_extra(spark, sf):
    return rounded(D.extra_to_cuts({"extra": fact(spark, sf, "extra")}, BY_CENTRE, CUTS), "attended_change_34")


@query(
    cte("attendance")
    + """, c AS (SELECT CENTRO__c,
      count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '2024-01-10') AS a,
      count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '2024-01-20') AS b
      FROM attendance GROUP BY CENTRO__c)
    SELECT CENTRO__c, round((b - a) / nullif(a, 0)::DOUBLE, 9) AS attended_change_12 FROM c"""
)
def variation_12(spark, sf):
    out = D.measure("7.19", {"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)
    return rounded(out, "attended_change_12")


@query(
    cte("attendance")
    + """SELECT DNI__c, round(max(A_REALES__c) / nullif(max(A_ESPERADAS__c), 0), 9) AS attendance_ratio
    FROM attendance GROUP BY DNI__c"""
)
def ratio_per_child(spark, sf):
    return rounded(D.measure("1.7", {"attendance": fact(spark, sf, "attendance")}), "attendance_ratio")


@query(
    cte("extra")
    + """, k AS (SELECT DNI__c, max(A_REALES__c) / nullif(max(A_ESPERADAS__c), 0) AS r FROM extra GROUP BY DNI__c)
    SELECT round(avg(r), 9) AS mean_attendance FROM k"""
)
def mean_ratio_per_child(spark, sf):
    return rounded(D.measure("1.8", {"attendance": fact(spark, sf, "extra")}), "mean_attendance")


@query(
    cte("extra")
    + """, k AS (SELECT DNI__c, max(A_REALES__c) / nullif(max(A_ESPERADAS__c), 0) AS r FROM extra GROUP BY DNI__c),
    g AS (SELECT DISTINCT ASISTENCIA__c, DNI__c FROM extra WHERE TIPO_ALUMNO__c = 'ACTIVO')
    SELECT ASISTENCIA__c, round(avg(r), 9) AS mean_attendance FROM g JOIN k USING (DNI__c) GROUP BY ASISTENCIA__c"""
)
def mean_ratio_by_mark(spark, sf):
    ctx = FilterContext(("ASISTENCIA__c",), {"TIPO_ALUMNO__c": lambda c: c == "ACTIVO"})
    return rounded(D.measure("1.8", {"attendance": fact(spark, sf, "extra")}, ctx), "mean_attendance")


@query(
    cte("attendance")
    + """, k AS (SELECT CENTRO__c, DNI__c, max(A_ESPERADAS__c) AS e,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'F'), 0) AS f,
      nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'FJ'), 0) AS j
      FROM attendance GROUP BY CENTRO__c, DNI__c)
    SELECT CENTRO__c, round(avg(f / nullif(e, 0)), 9) AS absence_rate, round(avg(j / nullif(e, 0)), 9) AS excused_rate
    FROM k GROUP BY CENTRO__c"""
)
def absence_pct(spark, sf):
    out = D.absence_means({"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)
    return rounded(out, "absence_rate", "excused_rate")


@query(
    cte("extra")
    + "SELECT CENTRO__c, nullif(count(DISTINCT FECHA__c), 0) AS class_days FROM extra GROUP BY CENTRO__c"
)
def class_days(spark, sf):
    return D.measure("1.11", {"attendance": fact(spark, sf, "extra")}, BY_CENTRE)


# --- children ----------------------------------------------------------------------------


@query(
    cte("attendance")
    + """, c AS (SELECT CENTRO__c,
      count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ('ACTIVO', 'INACTIVO') THEN DNI__c END) AS children_total,
      nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN DNI__c END), 0) AS active_children,
      nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c = 'INACTIVO' THEN DNI__c END), 0) AS inactive_children
      FROM attendance GROUP BY CENTRO__c)
    SELECT *, round(active_children / nullif(children_total, 0)::DOUBLE, 9) AS retention_rate,
      round(inactive_children / nullif(children_total, 0)::DOUBLE, 9) AS dropout_rate FROM c"""
)
def children_distinct(spark, sf):
    out = D.children({"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)
    return rounded(out, "retention_rate", "dropout_rate")


@query(
    cte("extra")
    + """SELECT ASISTENCIA__c,
      nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN DNI__c END), 0) AS active_children
      FROM extra GROUP BY ASISTENCIA__c"""
)
def active_distinct(spark, sf):
    return D.measure("2.2", {"attendance": fact(spark, sf, "extra")}, FilterContext(by=("ASISTENCIA__c",)))


@query(
    cte("extra")
    + """SELECT CENTRO__c,
      count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ('ACTIVO', 'INACTIVO') THEN DNI__c END) AS extra_children_total
      FROM extra GROUP BY CENTRO__c"""
)
def extra_children(spark, sf):
    return D.measure("2.4", {"extra": fact(spark, sf, "extra")}, BY_CENTRE)


@query(
    """WITH k AS (SELECT o_orderpriority AS grupo, o_custkey AS doc,
      min(v) AS lo, max(v) AS hi, count(*) FILTER (WHERE v IS NULL) AS gaps
      FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'SÍ' WHEN 'O' THEN 'NO' END AS v FROM orders) GROUP BY 1, 2)
    SELECT grupo, nullif(count(*) FILTER (WHERE lo = 'SÍ' AND hi = 'SÍ' AND gaps = 0), 0) AS children_with_disability
    FROM k GROUP BY grupo"""
)
def single_value_keys(spark, sf):
    requests = table(spark, sf, "orders").selectExpr(
        "o_orderpriority as grupo",
        "o_custkey as Nmero_de_Documento__c",
        "case o_orderstatus when 'F' then 'SÍ' when 'O' then 'NO' end as Cuenta_con_algn_tipo_de_discapacidad__c",
    )
    return D.measure("2.5", {"requests": requests}, FilterContext(by=("grupo",)))


@query("SELECT count(*) AS children_in_social_record FROM customer WHERE c_acctbal > 0")
def social_rows(spark, sf):
    ctx = FilterContext(filters={"c_acctbal": lambda c: c > 0})
    return D.measure("2.6", {"social": table(spark, sf, "customer")}, ctx)


@query("SELECT c_mktsegment, nullif(count(DISTINCT c_nationkey), 0) AS families FROM customer GROUP BY c_mktsegment")
def families_distinct(spark, sf):
    social = table(spark, sf, "customer").selectExpr("c_mktsegment", "c_nationkey as Nmero_de_Documento__c")
    return D.measure("2.16", {"social": social}, FilterContext(by=("c_mktsegment",)))


@query(
    cte("extra")
    + """, m AS (SELECT max(F_INCORPORACION__c) AS x FROM extra)
    SELECT CENTRO__c, nullif(count(DISTINCT CASE WHEN F_INCORPORACION__c
        BETWEEN date_trunc('month', m.x) AND last_day(m.x) THEN DNI__c END), 0) AS joined_last_month
    FROM extra, m GROUP BY CENTRO__c"""
)
def last_month_cohort(spark, sf):
    return D.measure("2.7", {"attendance": fact(spark, sf, "extra")}, BY_CENTRE)


@query(
    cte("extra")
    + """SELECT DNI__c, min(CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN FECHA__c END) AS activation_date,
      min(CASE WHEN TIPO_ALUMNO__c = 'INACTIVO' THEN FECHA__c END) AS dropout_date
      FROM extra GROUP BY DNI__c"""
)
def first_activation(spark, sf):
    return D.status_dates({"attendance": fact(spark, sf, "extra")}, FilterContext(), CUTS)


_MONTH_SQL = (
    cte("extra")
    + """, k AS (SELECT DNI__c, min(CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN FECHA__c END) AS fa,
      min(CASE WHEN TIPO_ALUMNO__c = 'INACTIVO' THEN FECHA__c END) AS fi FROM extra GROUP BY DNI__c),
    here AS (SELECT * FROM extra WHERE FECHA__c <= DATE '1996-03-31'),
    g AS (SELECT ASISTENCIA__c, max(FECHA__c) AS m FROM here GROUP BY ASISTENCIA__c),
    d AS (SELECT DISTINCT ASISTENCIA__c, DNI__c FROM here),
    c AS (SELECT g.ASISTENCIA__c,
      nullif(count(*) FILTER (WHERE date_trunc('month', fa) = date_trunc('month', m)), 0) AS new_active,
      nullif(count(*) FILTER (WHERE date_trunc('month', fi) = date_trunc('month', m)), 0) AS new_inactive
      FROM d JOIN k USING (DNI__c) JOIN g USING (ASISTENCIA__c) GROUP BY g.ASISTENCIA__c)
    """
)
_MONTH_CTX = FilterContext(("ASISTENCIA__c",), {"FECHA__c": lambda c: c <= dt.date(1996, 3, 31)})


@query(_MONTH_SQL + "SELECT ASISTENCIA__c, new_active FROM c")
def new_active_in_month(spark, sf):
    return D.measure("2.8", {"attendance": fact(spark, sf, "extra")}, _MONTH_CTX)


@query(
    _MONTH_SQL
    + """SELECT ASISTENCIA__c, CASE WHEN new_active IS NOT NULL OR new_inactive IS NOT NULL
      THEN coalesce(new_active, 0) + coalesce(new_inactive, 0) END AS impacted_in_month FROM c"""
)
def impacted(spark, sf):
    return D.measure("2.10", {"attendance": fact(spark, sf, "extra")}, _MONTH_CTX)


# --- grades ------------------------------------------------------------------------------


@query(
    cte("grades")
    + """, c AS (SELECT REA__c, count(DISTINCT DNI__c) AS evaluated_children,
      nullif(count(DISTINCT CASE WHEN EVALUACION__c = '2025-I' THEN DNI__c END), 0) AS graded_first,
      nullif(count(DISTINCT CASE WHEN EVALUACION__c = '2025-II' THEN DNI__c END), 0) AS graded_second
      FROM grades GROUP BY REA__c)
    SELECT *, round((coalesce(graded_second, 0) - coalesce(graded_first, 0)) / nullif(graded_first, 0)::DOUBLE, 9)
      AS graded_change FROM c"""
)
def evaluated_terms(spark, sf):
    out = D.evaluated({"grades": fact(spark, sf, "grades")}, FilterContext(by=("REA__c",)), CUTS)
    return rounded(out, "graded_change")


@query(
    cte("grades")
    + """SELECT REA__c, (SELECT count(DISTINCT DNI__c) FROM grades) AS evaluated_overall
    FROM grades WHERE NIVEL_DE_LOGRO__c = 'R' GROUP BY REA__c"""
)
def total_ignoring_filters(spark, sf):
    ctx = FilterContext(("REA__c",), {"NIVEL_DE_LOGRO__c": lambda c: c == "R"})
    return D.measure("3.2", {"grades": fact(spark, sf, "grades")}, ctx)


_LEVELS = (
    cte("extra")
    + """, w AS (SELECT CENTRO__c, count(DISTINCT FECHA__c) AS n FROM extra GROUP BY CENTRO__c),
    p AS (SELECT CENTRO__c, ASISTENCIA__c, count(DISTINCT FECHA__c) AS c FROM extra GROUP BY CENTRO__c, ASISTENCIA__c)
    """
)


def _levels(spark, sf, number):
    grades = fact(spark, sf, "extra").selectExpr(
        "CENTRO__c", "ASISTENCIA__c as NIVEL_DE_LOGRO__c", "cast(FECHA__c as string) as DNI__c"
    )
    return D.measure(number, {"grades": grades}, BY_CENTRE)


@query(
    _LEVELS
    + """SELECT CENTRO__c, ASISTENCIA__c AS "NIVEL_DE_LOGRO__c", n AS level_all,
      round(c / n::DOUBLE, 9) AS level_share FROM p JOIN w USING (CENTRO__c)"""
)
def share_ignoring_level(spark, sf):
    return rounded(_levels(spark, sf, "3.3"), "level_share")


@query(
    _LEVELS
    + """SELECT CENTRO__c, ASISTENCIA__c AS "NIVEL_DE_LOGRO__c", n AS level_all,
      printf('%.1f%%', round(100 * (c / n::DOUBLE), 1)) || '  (' || format('{:,}', c) || ' niños)' AS level_label
      FROM p JOIN w USING (CENTRO__c)"""
)
def label_pct_n(spark, sf):
    return _levels(spark, sf, "8.1")


@query(
    cte("grades")
    + """SELECT NIVEL_DE_LOGRO__c, avg_c AS mean_communication, avg_m AS mean_mathematics, avg_s AS mean_social,
      avg_t AS mean_technology, avg_ct AS mean_science FROM (SELECT NIVEL_DE_LOGRO__c,
      round(avg(Valor_Promedio__c) FILTER (WHERE REA__c = 'Comunicación'), 6) AS avg_c,
      round(avg(Valor_Promedio__c) FILTER (WHERE REA__c = 'Matemática'), 6) AS avg_m,
      round(avg(Valor_Promedio__c) FILTER (WHERE REA__c = 'Sociemocional'), 6) AS avg_s,
      round(avg(Valor_Promedio__c) FILTER (WHERE REA__c = 'Tecnología'), 6) AS avg_t,
      round(avg(Valor_Promedio__c) FILTER (WHERE REA__c = 'Ciencia y Tecnología'), 6) AS avg_ct
      FROM grades GROUP BY NIVEL_DE_LOGRO__c)"""
)
def area_pivot(spark, sf):
    out = D.area_means({"grades": fact(spark, sf, "grades")}, FilterContext(by=("NIVEL_DE_LOGRO__c",)), CUTS)
    return rounded(
        out, "mean_science", "mean_communication", "mean_mathematics", "mean_social", "mean_technology", digits=6
    )


@query(
    """SELECT p_type AS area, round(avg(l_quantity), 6) AS mean_score FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_type"""
)
def mean_by_area(spark, sf):
    areas = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    marks = join_lookup(table(spark, sf, "lineitem"), areas, ["l_partkey"])
    out = M.aggregate(marks, FilterContext(by=("p_type",)), mean_score=F.avg("l_quantity"))
    return rounded(out.withColumnRenamed("p_type", "area"), "mean_score", digits=6)


@query(
    cte("grades")
    + """, c AS (SELECT REA__c,
      nullif(count(Competencia_texto__c) FILTER (WHERE EVALUACION__c = '2025-I'), 0) AS competences_first,
      nullif(count(Competencia_texto__c) FILTER (WHERE EVALUACION__c = '2025-II'), 0) AS competences_second
      FROM grades GROUP BY REA__c)
    SELECT *, round((coalesce(competences_second, 0) - coalesce(competences_first, 0))
      / nullif(competences_first, 0)::DOUBLE, 9) AS competences_change FROM c"""
)
def competence_counts(spark, sf):
    out = D.competence_counts({"grades": fact(spark, sf, "grades")}, FilterContext(by=("REA__c",)), CUTS)
    return rounded(out, "competences_change")


@query(
    cte("curriculum")
    + """SELECT CENTRO__c, CASE WHEN count(DISTINCT AREA__c) = 1 THEN count(DISTINCT TEMAS__c) END AS topics_in_area
    FROM curriculum GROUP BY CENTRO__c UNION ALL
    SELECT CENTRO__c, CASE WHEN count(DISTINCT AREA__c) = 1 THEN count(DISTINCT TEMAS__c) END
    FROM curriculum WHERE AREA__c = 'ECONOMY' GROUP BY CENTRO__c"""
)
def topics_if_single_area(spark, sf):
    tables = {"curriculum": fact(spark, sf, "curriculum")}
    one = FilterContext(("CENTRO__c",), {"AREA__c": lambda c: c == "ECONOMY"})
    return D.measure("3.16", tables, BY_CENTRE).unionByName(D.measure("3.16", tables, one))


@query(
    cte("curriculum")
    + """, w AS (SELECT CENTRO__c, AREA__c, count(*) AS n FROM curriculum WHERE STATUS__c = 'AVANZADO' GROUP BY 1, 2),
    p AS (SELECT CENTRO__c, AREA__c, TEMAS__c, count(*) AS c FROM curriculum
      WHERE STATUS__c = 'AVANZADO' AND NIVEL__c = 'ALTO' GROUP BY 1, 2, 3)
    SELECT CENTRO__c, AREA__c, TEMAS__c,
      c || ' (' || printf('%.1f%%', round(100 * (c / n::DOUBLE), 1)) || ')' AS curriculum_label
    FROM p JOIN w USING (CENTRO__c, AREA__c)"""
)
def label_n_pct(spark, sf):
    ctx = FilterContext(
        ("CENTRO__c", "AREA__c", "TEMAS__c"),
        {"STATUS__c": lambda c: c == "AVANZADO", "NIVEL__c": lambda c: c == "ALTO"},
    )
    return D.measure("3.17", {"curriculum": fact(spark, sf, "curriculum")}, ctx)


# --- satisfaction ------------------------------------------------------------------------


def _child_answers(spark, sf):
    return table(spark, sf, "labels").selectExpr(
        "quality as Pregunta_1",
        "toxic as Pregunta_2",
        "quality + toxic as Pregunta_3",
        "doc_id % 5 as Pregunta_4",
        "case when quality = 1 then 4 end as Pregunta_5",
    )


@query(
    """SELECT round(avg(quality), 9) AS child_question_1, round(avg(toxic), 9) AS child_question_2,
      round(avg(quality + toxic), 9) AS child_question_3, round(avg(doc_id % 5), 9) AS child_question_4,
      round(avg(CASE WHEN quality = 1 THEN 4 END), 9) AS child_question_5 FROM labels"""
)
def plain_mean(spark, sf):
    out = D.child_satisfaction({"children_satisfaction": _child_answers(spark, sf)}, FilterContext(), CUTS)
    return rounded(out, *out.columns)


@query(
    cte("survey")
    + """SELECT CENTRO__c, nullif(count(DISTINCT N_de_documento__c), 0) AS answering_parents FROM survey GROUP BY CENTRO__c"""
)
def answering_parents(spark, sf):
    return D.measure("4.6", {"survey": fact(spark, sf, "survey")}, BY_CENTRE)


@query(
    cte("survey")
    + """SELECT CENTRO__c, nullif(count(DISTINCT N_de_documento_1__c), 0) AS children_of_answering
    FROM survey GROUP BY CENTRO__c"""
)
def children_of_answering(spark, sf):
    return D.measure("4.7", {"survey": fact(spark, sf, "survey")}, BY_CENTRE)


@query(
    cte("survey")
    + """, p AS (SELECT CENTRO__c, P1, count(*) AS c FROM survey GROUP BY 1, 2)
    SELECT CENTRO__c, P1, c || ' (' || printf('%.1f%%', round(100 * (c / (sum(c) OVER (PARTITION BY CENTRO__c))::DOUBLE), 1))
      || ')' AS improved_label FROM p"""
)
def survey_answer_label(spark, sf):
    return D.measure("4.8", {"survey": fact(spark, sf, "survey")}, BY_CENTRE, CUTS)


@query(
    cte("survey")
    + """SELECT CENTRO__c, P1 AS answer, CASE P1 WHEN 'MUY EN DESACUERDO' THEN 1 WHEN 'EN DESACUERDO' THEN 2
      WHEN 'DE ACUERDO' THEN 3 WHEN 'MUY DE ACUERDO' THEN 4 END AS answer_level,
      coalesce(P1, 'Sin respuesta') AS answer_legend,
      CASE P1 WHEN 'MUY EN DESACUERDO' THEN 1 WHEN 'EN DESACUERDO' THEN 2
      WHEN 'DE ACUERDO' THEN 3 WHEN 'MUY DE ACUERDO' THEN 4 END AS unified_level FROM survey"""
)
def answer_level(spark, sf):
    return D.answers({"survey": fact(spark, sf, "survey")}, BY_CENTRE, CUTS)


@query(
    cte("survey")
    + """SELECT CENTRO__c, CASE WHEN P2 IN ('MUY EN DESACUERDO', 'NUNCA') THEN 1 WHEN P2 IN ('EN DESACUERDO', 'A VECES') THEN 2
      WHEN P2 IN ('DE ACUERDO', 'CASI SIEMPRE') THEN 3 WHEN P2 IN ('MUY DE ACUERDO', 'SIEMPRE') THEN 4 END AS unified_level,
      count(*) AS answers_at_level FROM survey GROUP BY 1, 2"""
)
def level_counts(spark, sf):
    from dataclasses import replace

    return D.measure("4.15", {"survey": fact(spark, sf, "survey")}, BY_CENTRE, replace(CUTS, question="segunda"))


@query(
    """WITH i AS (SELECT o_orderstatus AS grupo,
      CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 4 WHEN '4-NOT SPECIFIED' THEN 2 END AS x
      FROM orders)
    SELECT grupo, round(count(*) FILTER (WHERE x = 1) / count(x)::DOUBLE, 9) AS indicator_share_1,
      round(count(*) FILTER (WHERE x = 3) / count(x)::DOUBLE, 9) AS indicator_share_3,
      round(count(*) FILTER (WHERE x = 4) / count(x)::DOUBLE, 9) AS indicator_share_4 FROM i GROUP BY grupo"""
)
def answer_share(spark, sf):
    indicators = table(spark, sf, "orders").selectExpr(
        "o_orderstatus as grupo",
        "case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 3 when '3-MEDIUM' then 4 "
        "when '4-NOT SPECIFIED' then 2 end as Indicador_4__c",
    )
    out = D.indicator_shares({"indicators": indicators}, FilterContext(by=("grupo",)), CUTS)
    return rounded(out, "indicator_share_1", "indicator_share_3", "indicator_share_4")


# --- skills ------------------------------------------------------------------------------

_SKILLS = (
    cte("skills")
    + """, w AS (SELECT Centro__c, count(DISTINCT DNI__c) AS n FROM skills GROUP BY Centro__c),
    p AS (SELECT Centro__c, Nivel_de_logro__c, count(DISTINCT DNI__c) AS c FROM skills GROUP BY 1, 2)
    """
)


@query(
    _SKILLS
    + """SELECT Centro__c, Nivel_de_logro__c, c AS skill_level_children, round(c / n::DOUBLE, 9) AS skill_level_share,
      printf('%.1f%%', round(100 * (c / n::DOUBLE), 1)) || '  (' || format('{:,}', c) || ' niños)' AS skill_percent_count,
      format('{:,}', c) || ' (' || printf('%.1f%%', round(100 * (c / n::DOUBLE), 1)) || ')' AS skill_count_percent
    FROM p JOIN w USING (Centro__c)"""
)
def skill_levels(spark, sf):
    out = D.skill_levels({"skills": fact(spark, sf, "skills")}, FilterContext(by=("Centro__c",)), CUTS)
    return rounded(out, "skill_level_share")


@query(
    cte("skills")
    + """, s AS (SELECT * FROM skills WHERE Nivel_de_logro__c IN ('Logrado', 'Sobresaliente')),
    w AS (SELECT Centro__c, count(DISTINCT DNI__c) AS w FROM s GROUP BY 1)
    SELECT Centro__c, Nivel_de_logro__c, count(DISTINCT DNI__c) AS skill_level_children,
      round(count(DISTINCT DNI__c) / any_value(w)::DOUBLE, 9) AS skill_level_share FROM s JOIN w USING (Centro__c) GROUP BY 1, 2"""
)
def skill_share_selected(spark, sf):
    """A slicer on the level limits the whole as well as the parts."""
    chosen = FilterContext(
        by=("Centro__c",), filters={"Nivel_de_logro__c": lambda c: c.isin("Logrado", "Sobresaliente")}
    )
    out = D.skill_levels({"skills": fact(spark, sf, "skills")}, chosen, CUTS)
    out = out.select("Centro__c", "Nivel_de_logro__c", "skill_level_children", "skill_level_share")
    return rounded(out, "skill_level_share")


@query(
    cte("skills")
    + """, p AS (SELECT Centro__c, Nivel_de_logro__c, count(DNI__c) AS c FROM skills GROUP BY 1, 2)
    SELECT Centro__c, Nivel_de_logro__c, format('{:,}', c) || ' (' ||
      printf('%.1f%%', round(100 * (c / (sum(c) OVER (PARTITION BY Centro__c))::DOUBLE), 1)) || ')' AS skill_rows_label FROM p"""
)
def skill_rows_label(spark, sf):
    return D.measure("5.9", {"skills": fact(spark, sf, "skills")}, FilterContext(by=("Centro__c",)))


@query(
    cte("skills")
    + """SELECT Centro__c, count(DNI__c) FILTER (WHERE Nivel_de_logro__c = 'Logrado') AS achieved,
      nullif(count(DNI__c) FILTER (WHERE Nivel_de_logro__c = 'Sobresaliente'), 0) AS outstanding
      FROM skills GROUP BY Centro__c"""
)
def skill_results(spark, sf):
    return D.skill_results({"skills": fact(spark, sf, "skills")}, FilterContext(by=("Centro__c",)), CUTS)


@query(cte("skills") + "SELECT DNI__c, max(Nivel_de_logro__c) AS level_label_fixed FROM skills GROUP BY DNI__c")
def level_label_max(spark, sf):
    return D.measure("5.8", {"skills": fact(spark, sf, "skills")}, FilterContext(by=("DNI__c",)))


# --- workshops and hours -----------------------------------------------------------------


@query(
    cte("attendance")
    + """SELECT CENTRO__c, count(DISTINCT CASE WHEN ASISTENCIA__c = 'A' THEN DNI__c END) AS experiential_children,
      count(DISTINCT CASE WHEN ASISTENCIA__c = 'A' THEN cast(FECHA__c AS string) || TIPO_ALUMNO__c END) AS experiential_events
      FROM attendance GROUP BY CENTRO__c"""
)
def workshop_reach(spark, sf):
    marks = fact(spark, sf, "attendance").selectExpr(
        "CENTRO__c", "DNI__c", "FECHA__c", "TIPO_ALUMNO__c as ACTIVIDAD__c", "ASISTENCIA__c as VALOR__c"
    )
    tables = {"experiential": marks}
    children = D.measure("6.2", tables, BY_CENTRE)
    events = D.measure("6.3", tables, BY_CENTRE)
    return children.join(events, "CENTRO__c")


def _hours(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "concat('NATION_', cast(l_suppkey % 30 as string)) as Nombre_Limpio", "l_quantity as Valor"
    )


@query("SELECT sum(l_quantity) AS learning_hours FROM lineitem")
def hours_total(spark, sf):
    return D.measure("6.4", {"hours": _hours(spark, sf)})


@query(
    """WITH hours AS (SELECT 'NATION_' || (l_suppkey % 30) AS centre, l_quantity AS v FROM lineitem)
    SELECT sum(v) AS learning_hours_selected FROM hours WHERE centre = 'NATION_7'
    UNION ALL SELECT sum(v) FROM hours"""
)
def hours_selected(spark, sf):
    tables = {
        "hours": _hours(spark, sf),
        "attendance": table(spark, sf, "nation").withColumnRenamed("n_name", "Centro_Limpio"),
    }
    one = FilterContext(filters={"n_nationkey": lambda c: c == 7})
    return D.measure("6.5", tables, one).unionByName(D.measure("6.5", tables))


@query(
    """WITH hours AS (SELECT 'NATION_' || (l_suppkey % 30) AS centre, l_quantity AS v FROM lineitem)
    SELECT n_name AS "Centro_Limpio", sum(v) AS learning_hours_selected FROM nation LEFT JOIN hours ON centre = n_name GROUP BY 1"""
)
def hours_selected_by_centre(spark, sf):
    """Grouped by centre, every group has one centre selected."""
    tables = {
        "hours": _hours(spark, sf),
        "attendance": table(spark, sf, "nation").withColumnRenamed("n_name", "Centro_Limpio"),
    }
    return D.measure("6.5", tables, FilterContext(by=("Centro_Limpio",)))


@query(
    """SELECT 'NATION_' || (l_suppkey % 30) AS "Nombre_Limpio", sum(l_quantity) AS learning_hours_selected FROM lineitem
    WHERE 'NATION_' || (l_suppkey % 30) IN (SELECT n_name FROM nation) GROUP BY 1"""
)
def treatas(spark, sf):
    tables = {
        "hours": _hours(spark, sf),
        "attendance": table(spark, sf, "nation").withColumnRenamed("n_name", "Centro_Limpio"),
    }
    return D.hours_by_centre(tables, FilterContext(), CUTS)


# --- impact ------------------------------------------------------------------------------


@query(
    cte("attendance")
    + "SELECT CENTRO__c, "
    + ", ".join(
        f"nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({v}) AND FECHA__c <= DATE '{d}' THEN DNI__c END), 0) AS {n}_{c}"
        for n, v in {"active": "'ACTIVO'", "inactive": "'INACTIVO'", "impacted": "'ACTIVO', 'INACTIVO'"}.items()
        for c, d in {"cut1": "2024-01-10", "cut2": "2024-01-20"}.items()
    )
    + " FROM attendance GROUP BY CENTRO__c"
)
def impact_to_cuts(spark, sf):
    return D.impact_regular({"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS)


@query(
    cte("survey")
    + """, p AS (SELECT CENTRO__c, P2, count(*) AS c FROM survey GROUP BY 1, 2)
    SELECT CENTRO__c, P2, c || ' (' || printf('%.1f%%', round(100 * (c / (sum(c) OVER (PARTITION BY CENTRO__c))::DOUBLE), 1))
      || ')' AS learned_label FROM p"""
)
def survey_learned_label(spark, sf):
    return D.measure("4.9", {"survey": fact(spark, sf, "survey")}, BY_CENTRE, CUTS)


@query(cte("survey") + "SELECT CENTRO__c, nullif(count(*), 0) AS answers FROM survey GROUP BY CENTRO__c")
def survey_answers(spark, sf):
    return D.measure("4.12", {"survey": fact(spark, sf, "survey")}, BY_CENTRE, CUTS)


@query("SELECT o_orderstatus AS grupo, nullif(count(DISTINCT o_custkey % 97), 0) AS guardians FROM orders GROUP BY 1")
def guardians(spark, sf):
    table_ = table(spark, sf, "orders").selectExpr("o_orderstatus as grupo", "cast(o_custkey % 97 as string) as Apoderado_DNI__c")
    return D.measure("2.15", {"guardians": table_}, FilterContext(by=("grupo",)))


@query("SELECT o_orderstatus AS grupo, nullif(count(DISTINCT o_custkey), 0) AS skill_children FROM orders GROUP BY 1")
def workshop_children(spark, sf):
    table_ = table(spark, sf, "orders").selectExpr("o_orderstatus as grupo", "cast(o_custkey as string) as DNI")
    return D.measure("5.1", {"workshops": table_}, FilterContext(by=("grupo",)))


@query(
    cte("attendance")
    + ", x AS ("
    + " UNION ALL ".join(
        f"""SELECT CENTRO__c, '{label}' AS fila,
        nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({v}) AND FECHA__c <= DATE '2024-01-10' THEN DNI__c END), 0) AS value_cut1,
        nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({v}) AND FECHA__c <= DATE '2024-01-20' THEN DNI__c END), 0) AS value_cut2
        FROM attendance GROUP BY CENTRO__c"""
        for label, v in {
            "N° de niños(as) impactados": "'ACTIVO', 'INACTIVO'",
            "N° niños activos": "'ACTIVO'",
            "N° niños inactivos": "'INACTIVO'",
        }.items()
    )
    + """) SELECT *, round((coalesce(value_cut2, 0) - coalesce(value_cut1, 0)) / nullif(value_cut1, 0)::DOUBLE, 9)
    AS change_12 FROM x"""
)
def slicer_regular(spark, sf):
    return rounded(D.slicer_regular({"attendance": fact(spark, sf, "attendance")}, BY_CENTRE, CUTS), "change_12")


@query(
    cte("extra")
    + ", x AS ("
    + " UNION ALL ".join(
        f"""SELECT CENTRO__c, '{label}' AS fila,
        nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({v}) AND FECHA__c <= DATE '1997-06-30' THEN DNI__c END), 0) AS value_cut3,
        nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({v}) AND FECHA__c <= DATE '1999-06-30' THEN DNI__c END), 0) AS value_cut4
        FROM extra GROUP BY CENTRO__c"""
        for label, v in {
            "N° de niños(as) impactados": "'ACTIVO', 'INACTIVO'",
            "N° niños activos": "'ACTIVO'",
            "N° niños inactivos": "'INACTIVO'",
        }.items()
    )
    + """) SELECT *, round((coalesce(value_cut4, 0) - coalesce(value_cut3, 0)) / nullif(value_cut3, 0)::DOUBLE, 9)
    AS change_34 FROM x"""
)
def slicer_measure(spark, sf):
    return rounded(D.slicer_extra({"extra": fact(spark, sf, "extra")}, BY_CENTRE, CUTS), "change_34")


@query(
    cte("extra")
    + """SELECT * FROM (SELECT CENTRO__c, '1.2' AS "number", 'extra_attendances' AS measure,
      cast(nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0) AS string) AS value FROM extra GROUP BY 1)
    UNION ALL SELECT CENTRO__c, '2.4', 'extra_children_total',
      cast(count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ('ACTIVO', 'INACTIVO') THEN DNI__c END) AS string) FROM extra GROUP BY 1
    UNION ALL SELECT CENTRO__c, '6.1', 'extra_workshops', cast(nullif(count(DISTINCT FECHA__c), 0) AS string) FROM extra GROUP BY 1
    UNION ALL SELECT CENTRO__c, '7.10', 'active_extra_cut4', cast(nullif(count(DISTINCT CASE WHEN TIPO_ALUMNO__c = 'ACTIVO'
      AND FECHA__c <= DATE '1999-06-30' THEN DNI__c END), 0) AS string) FROM extra GROUP BY 1"""
)
def dashboard_long(spark, sf):
    return D.evaluate(["1.2", "2.4", "6.1", "7.10"], {"extra": fact(spark, sf, "extra")}, BY_CENTRE, CUTS)


def _long_sql(table: str, *lines: tuple[str, str, str]) -> str:
    """Long form of measures per centre: number, name, expression."""
    return " UNION ALL ".join(
        f"""SELECT CENTRO__c, '{number}' AS "number", '{name}' AS measure, cast({value} AS string) AS value FROM {table} GROUP BY 1"""
        for number, name, value in lines
    )


def _children_sql(status: str, cut: str = "TRUE") -> str:
    return f"count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ({status}) AND {cut} THEN DNI__c END)"


@query(
    cte("attendance", "extra")
    + _long_sql(
        "attendance",
        ("1.1", "attendances", "nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0)"),
        ("1.4", "attended_cut2", "nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A' AND FECHA__c <= DATE '2024-01-20'), 0)"),
        ("1.11", "class_days", "nullif(count(DISTINCT FECHA__c), 0)"),
        ("2.1", "children_total", _children_sql("'ACTIVO', 'INACTIVO'")),
        ("2.3", "inactive_children", f"nullif({_children_sql("'INACTIVO'")}, 0)"),
        ("7.6", "impacted_cut2", f"nullif({_children_sql("'ACTIVO', 'INACTIVO'", "FECHA__c <= DATE '2024-01-20'")}, 0)"),
    )
    + " UNION ALL "
    + _long_sql(
        "extra",
        ("1.2", "extra_attendances", "nullif(count(*) FILTER (WHERE ASISTENCIA__c = 'A'), 0)"),
        ("2.4", "extra_children_total", _children_sql("'ACTIVO', 'INACTIVO'")),
        ("6.1", "extra_workshops", "nullif(count(DISTINCT FECHA__c), 0)"),
        ("7.10", "active_extra_cut4", f"nullif({_children_sql("'ACTIVO'", "FECHA__c <= DATE '1999-06-30'")}, 0)"),
    )
)
def page_long(spark, sf):
    """A page of ten measures, with one scan of each of its two tables."""
    numbers = ["1.1", "1.4", "1.11", "2.1", "2.3", "7.6", "1.2", "2.4", "6.1", "7.10"]
    return evaluate_page(numbers, {t: fact(spark, sf, t) for t in ("attendance", "extra")}, BY_CENTRE, CUTS)


def _child_bits(spark, sf, condition: str = "true", numbers=None):
    """Stored bits of the children per centre, day and status."""
    df = fact(spark, sf, "attendance").filter(condition)
    numbers = bitmaps.number_keys(fact(spark, sf, "attendance"), "DNI__c", ["CENTRO__c"]) if numbers is None else numbers
    dims = {"CENTRO__c": F.col("CENTRO__c"), "dia": F.col("FECHA__c"), "estado": F.col("TIPO_ALUMNO__c")}
    return bitmaps.key_bitmaps(df, "DNI__c", dims, numbers)


@query(
    cte("attendance")
    + f"""SELECT CENTRO__c, count(DISTINCT DNI__c) AS todos, {_children_sql("'ACTIVO'")} AS activos,
      {_children_sql("'ACTIVO', 'INACTIVO'", "FECHA__c <= DATE '2024-01-10'")} AS corte_1,
      {_children_sql("'ACTIVO', 'INACTIVO'", "FECHA__c <= DATE '2024-01-20'")} AS corte_2 FROM attendance GROUP BY 1"""
)
def bitmap_children_to_cuts(spark, sf):
    """Distinct children per centre, by status and up to two dates, from stored bits."""
    known = F.col("estado").isin("ACTIVO", "INACTIVO")
    day = F.col("dia")
    return bitmaps.count_keys(
        _child_bits(spark, sf),
        ["CENTRO__c"],
        todos=F.lit(True),
        activos=F.col("estado") == "ACTIVO",
        corte_1=known & (day <= dt.date(2024, 1, 10)),
        corte_2=known & (day <= dt.date(2024, 1, 20)),
    )


@query(
    cte("attendance")
    + """SELECT date_trunc('month', FECHA__c)::DATE AS mes, TIPO_ALUMNO__c AS estado, count(DISTINCT DNI__c) AS todos
    FROM attendance GROUP BY 1, 2"""
)
def bitmap_children_by_month(spark, sf):
    """Distinct children per month and status, united from bits stored per day and centre."""
    store = _child_bits(spark, sf).withColumn("mes", F.trunc("dia", "month").cast("date"))
    return bitmaps.count_keys(store, ["mes", "estado"], todos=F.lit(True))


@query(cte("attendance") + f"""SELECT count(DISTINCT DNI__c) AS todos, {_children_sql("'INACTIVO'")} AS inactivos FROM attendance""")
def bitmap_two_loads(spark, sf):
    """Totals over two loads stored apart and united; neither load is read for the counts."""
    numbers = bitmaps.number_keys(fact(spark, sf, "attendance"), "DNI__c")
    early = "FECHA__c < date'2024-01-15'"
    loads = [_child_bits(spark, sf, c, numbers) for c in (early, f"not ({early})")]
    store = bitmaps.united(loads, ["CENTRO__c", "dia", "estado"])
    return bitmaps.count_keys(store, todos=F.lit(True), inactivos=F.col("estado") == "INACTIVO")


@query(
    cte("attendance", "grades", "skills")
    + """, c AS (SELECT count(DISTINCT CASE WHEN TIPO_ALUMNO__c IN ('ACTIVO', 'INACTIVO') THEN DNI__c END) AS t,
      count(DISTINCT CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN DNI__c END) AS a FROM attendance),
    k AS (SELECT avg(r) AS m FROM (SELECT max(A_REALES__c) / nullif(max(A_ESPERADAS__c), 0) AS r FROM attendance GROUP BY DNI__c))
    SELECT kpi, round(value, 9) AS value, target, value > target AS reached FROM (
      SELECT 'children_total' AS kpi, t::DOUBLE AS value, 1000::DOUBLE AS target FROM c
      UNION ALL SELECT 'retention_rate', a / t::DOUBLE, 0.85::DOUBLE FROM c
      UNION ALL SELECT 'mean_attendance', m, 0.8::DOUBLE FROM k
      UNION ALL SELECT 'level_share', count(DISTINCT CASE WHEN NIVEL_DE_LOGRO__c IN ('A', 'N') THEN DNI__c END)
        / count(DISTINCT DNI__c)::DOUBLE, 0.7::DOUBLE FROM grades
      UNION ALL SELECT 'child_satisfaction', (avg(quality) + avg(toxic) + avg(quality + toxic) + avg(doc_id % 5) + 4) / 5,
        3.5::DOUBLE FROM labels
      UNION ALL SELECT 'skill_share', count(*) FILTER (WHERE Nivel_de_logro__c IN ('Logrado', 'Sobresaliente')) / count(*)::DOUBLE,
        0.6::DOUBLE FROM skills)"""
)
def kpi_report(spark, sf):
    tables = {name: fact(spark, sf, name) for name in ("attendance", "grades", "skills")}
    tables["children_satisfaction"] = _child_answers(spark, sf)
    return rounded(D.kpi_report(tables, Settings(reached_levels=("A", "N"))), "value")


@query("SELECT n_name AS \"Nombre_Limpio\", substr(n_name, 7, 1) AS letter FROM nation")
def substring_at(spark, sf):
    return D.measure("8.4", {"hours": table(spark, sf, "nation").withColumnRenamed("n_name", "Nombre_Limpio")})
