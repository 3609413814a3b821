"""The measure layer: every measure by number, in blocks that share their passes.

A block builds one DataFrame with the grouping columns and one column per measure, so that
measures over the same table and context are computed together. ``measure`` returns a single
one; ``evaluate`` returns any selection in long form (group, measure, value).

Tables (column names as loaded):

========== ============================================================================
attendance DNI__c, FECHA__c, ASISTENCIA__c, TIPO_ALUMNO__c, A_REALES__c, A_ESPERADAS__c,
           F_INCORPORACION__c
extra      as attendance
grades     DNI__c, REA__c, NIVEL_DE_LOGRO__c, Valor_Promedio__c, EVALUACION__c,
           Competencia_texto__c
curriculum AREA__c, TEMAS__c, CENTRO__c, STATUS__c, CICLO__c, BIMESTRE__c
survey     N_de_documento__c, N_de_documento_1__c, question columns
children_satisfaction Pregunta_1 … Pregunta_5
indicators Indicador_4__c
requests   Nmero_de_Documento__c, Cuenta_con_algn_tipo_de_discapacidad__c
social     Nmero_de_Documento__c
guardians  Apoderado_DNI__c
workshops  DNI
skills     DNI__c, Nivel_de_logro__c
experiential DNI__c, FECHA__c, ACTIVIDAD__c, VALOR__c
hours      Nombre_Limpio, Valor
========== ============================================================================
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.functions.mapping import map_or_null
from aulario.functions.numbers import change, count_percent, divide, percent_count
from aulario.functions.text import substring_at
from aulario.operators import measures as M
from aulario.operators.combine import union_aligned
from aulario.operators.joins import keep_values_of
from aulario.operators.measures import FilterContext, blank
from aulario.operators.reshape import chosen_question
from aulario.plans import constants as K

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """Slicer choices and wordings the measures read."""

    cuts: Mapping[int, dt.date | None] = field(default_factory=dict)
    year: int = 2025
    science_area: str = "Ciencia y Tecnología"
    social_area: str = "Sociemocional"
    attended: str = "A"
    question: str | None = None
    questions: Mapping[str, str] = field(default_factory=dict)
    scales: Sequence[Mapping[str, int]] = (K.AGREEMENT,)
    improved_school: str = "Considero_que_mi_hijo_mejor_en_el_coleg__c"
    learned_by_playing: str = "Considero_que_mis_hijos_aprendieron__c"
    legend_level: int | None = None
    slicer_row: str | None = None
    reached_levels: Sequence[str] = ("Logrado", "Sobresaliente")


def _status(*values: str) -> Column:
    return F.col("TIPO_ALUMNO__c").isin(*values)


def _mark(value: str) -> Column:
    return F.col("ASISTENCIA__c") == value


# --- attendance --------------------------------------------------------------------------


def attendance_counts(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(t["attendance"], ctx, attendances=M.count_where(_mark("A")))


def extra_counts(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(t["extra"], ctx, extra_attendances=M.count_where(_mark("A")))


def attendance_to_cuts(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.cumulative_counts(
        t["attendance"],
        ctx,
        "FECHA__c",
        attended_cut1=(_mark("A"), s.cuts.get(1)),
        attended_cut2=(_mark("A"), s.cuts.get(2)),
    )
    return M.relative_change(out, "attended_cut1", "attended_cut2", "attended_change_12")


def extra_to_cuts(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.cumulative_counts(
        t["extra"],
        ctx,
        "FECHA__c",
        attended_cut3=(_mark("A"), s.cuts.get(3)),
        attended_cut4=(_mark("A"), s.cuts.get(4)),
    )
    return M.relative_change(out, "attended_cut3", "attended_cut4", "attended_change_34")


def attendance_by_child(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per child; the ratio of a child ignores every other filter."""
    return M.ratio_per_key(t["attendance"], "DNI__c", "A_REALES__c", "A_ESPERADAS__c", "attendance_ratio")


def attendance_mean(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.mean_ratio_over_keys(
        t["attendance"], ctx, "DNI__c", "A_REALES__c", "A_ESPERADAS__c", "mean_attendance"
    )


def absence_means(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.mean_rate_over_keys(
        t["attendance"], ctx, "DNI__c", "A_ESPERADAS__c", absence_rate=_mark("F"), excused_rate=_mark("FJ")
    )


def class_days(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["attendance"], ctx, "FECHA__c", class_days=F.lit(True))
    return out.withColumn("class_days", blank(F.col("class_days")))


def extra_days(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["extra"], ctx, "FECHA__c", extra_workshops=F.lit(True))
    return out.withColumn("extra_workshops", blank(F.col("extra_workshops")))


# --- children ----------------------------------------------------------------------------


def children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(
        t["attendance"],
        ctx,
        "DNI__c",
        children_total=_status("ACTIVO", "INACTIVO"),
        active=_status("ACTIVO"),
        inactive=_status("INACTIVO"),
    )
    return out.select(
        *ctx.by,
        "children_total",
        blank(F.col("active")).alias("active_children"),
        blank(F.col("inactive")).alias("inactive_children"),
        divide(blank(F.col("active")), F.col("children_total")).alias("retention_rate"),
        divide(blank(F.col("inactive")), F.col("children_total")).alias("dropout_rate"),
    )


def extra_children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.distinct_counts(t["extra"], ctx, "DNI__c", extra_children_total=_status("ACTIVO", "INACTIVO"))


def disability(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.keys_with_single_value(
        t["requests"],
        ctx,
        "Nmero_de_Documento__c",
        "Cuenta_con_algn_tipo_de_discapacidad__c",
        "SÍ",
        "children_with_disability",
    )


def social_rows(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(t["social"], ctx, children_in_social_record=F.count(F.lit(1)))


def newest_children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.last_month_cohort(t["attendance"], ctx, "DNI__c", "F_INCORPORACION__c", "joined_last_month")


def month_changes(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.first_in_current_month(
        t["attendance"], ctx, "DNI__c", "FECHA__c", new_active=_status("ACTIVO"), new_inactive=_status("INACTIVO")
    )
    return out.withColumn("impacted_in_month", M.add(F.col("new_active"), F.col("new_inactive")))


def status_dates(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per child: first date as active and as inactive."""
    return M.first_dates(
        t["attendance"], "DNI__c", "FECHA__c", activation_date=_status("ACTIVO"), dropout_date=_status("INACTIVO")
    )


def guardians(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["guardians"], ctx, "Apoderado_DNI__c", guardians=F.lit(True))
    return out.withColumn("guardians", blank(F.col("guardians")))


def families(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["social"], ctx, "Nmero_de_Documento__c", families=F.lit(True))
    return out.withColumn("families", blank(F.col("families")))


# --- grades ------------------------------------------------------------------------------


def evaluated(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    term = F.col("EVALUACION__c")
    out = M.distinct_counts(
        t["grades"],
        ctx,
        "DNI__c",
        evaluated_children=F.lit(True),
        graded_first=term == f"{s.year}-I",
        graded_second=term == f"{s.year}-II",
    )
    out = out.select(
        *ctx.by, *[blank(F.col(c)).alias(c) for c in ("evaluated_children", "graded_first", "graded_second")]
    )
    return M.relative_change(out, "graded_first", "graded_second", "graded_change")


def evaluated_total(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.total_ignoring_filters(t["grades"], ctx, "DNI__c", "evaluated_overall", "evaluated_here")
    return out.drop("evaluated_here")


def grade_levels(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per achievement level in the group."""
    out = M.share_of_distinct(
        t["grades"], ctx, "NIVEL_DE_LOGRO__c", "DNI__c", "level_children", "level_all", "level_share"
    )
    return out.withColumn("level_label", percent_count(F.col("level_share"), F.col("level_children"), "niños"))


def area_means(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    areas = {
        "mean_science": s.science_area,
        "mean_communication": "Comunicación",
        "mean_mathematics": "Matemática",
        "mean_social": s.social_area,
        "mean_technology": "Tecnología",
    }
    return M.aggregate(
        t["grades"], ctx, **{n: F.avg(F.when(F.col("REA__c") == a, F.col("Valor_Promedio__c"))) for n, a in areas.items()}
    )


def competence_counts(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    filled = F.col("Competencia_texto__c").isNotNull()
    term = F.col("EVALUACION__c")
    out = M.aggregate(
        t["grades"],
        ctx,
        competences_first=M.count_where(filled & (term == f"{s.year}-I")),
        competences_second=M.count_where(filled & (term == f"{s.year}-II")),
    )
    return M.relative_change(out, "competences_first", "competences_second", "competences_change")


def topics(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.distinct_if_single(t["curriculum"], ctx, "AREA__c", "TEMAS__c", "topics_in_area")


def curriculum_label(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    keep = ("CENTRO__c", "AREA__c", "STATUS__c", "CICLO__c", "BIMESTRE__c")
    out = M.share_keeping(t["curriculum"], ctx, keep)
    return out.select(*ctx.by, count_percent(F.col("part"), F.col("share")).alias("curriculum_label"))


# --- satisfaction ------------------------------------------------------------------------


def child_satisfaction(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(
        t["children_satisfaction"], ctx, **{f"child_question_{i}": F.avg(f"Pregunta_{i}") for i in range(1, 6)}
    )


def survey_parents(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["survey"], ctx, "N_de_documento__c", answering_parents=F.lit(True))
    return out.withColumn("answering_parents", blank(F.col("answering_parents")))


def survey_children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["survey"], ctx, "N_de_documento_1__c", children_of_answering=F.lit(True))
    return out.withColumn("children_of_answering", blank(F.col("children_of_answering")))


def _answer_label(column: str, name: str):
    def build(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
        over = getattr(s, column)
        out = M.share_of_rows(t["survey"], ctx, over)
        by = [c for c in ctx.by if c != over]
        return out.select(*by, over, count_percent(F.col("part"), F.col("share")).alias(name))

    return build


def unified_level(answer: Column, scales: Sequence[Mapping[str, int]]) -> Column:
    """Level 1–4 of an answer on any of the scales."""
    return F.coalesce(*[map_or_null(answer, scale) for scale in scales])


def answers(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per respondent for the chosen question: answer, levels and legend."""
    out = chosen_question(ctx.apply(t["survey"]), list(ctx.by), s.questions, s.question)
    answer = F.col("respuesta")
    return out.select(
        *ctx.by,
        answer.alias("answer"),
        map_or_null(answer, K.AGREEMENT).alias("answer_level"),
        F.coalesce(answer, F.lit(K.NO_ANSWER)).alias("answer_legend"),
        unified_level(answer, s.scales).alias("unified_level"),
    )


def survey_rows(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(t["survey"], ctx, answers=blank(F.count(F.lit(1))))


def level_rows(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Answers per unified level, or at the legend level chosen."""
    levels = answers(t, ctx, s)
    out = levels.groupBy(*ctx.by, "unified_level").agg(F.count(F.lit(1)).alias("answers_at_level"))
    return out if s.legend_level is None else out.filter(F.col("unified_level") == s.legend_level)


def indicator_shares(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.answer_shares(
        t["indicators"], ctx, "Indicador_4__c", indicator_share_1=1, indicator_share_3=3, indicator_share_4=4
    )


# --- skills ------------------------------------------------------------------------------


def workshop_children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    out = M.distinct_counts(t["workshops"], ctx, "DNI", skill_children=F.lit(True))
    return out.withColumn("skill_children", blank(F.col("skill_children")))


def skill_levels(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per skill level: distinct children, share of all that a slicer leaves, and the labels."""
    out = M.share_of_distinct(
        t["skills"], ctx, "Nivel_de_logro__c", "DNI__c", "skill_level_children", "all", "skill_level_share", keep_filter=True
    )
    n, share = F.col("skill_level_children"), F.col("skill_level_share")
    return out.drop("all").withColumns(
        {
            "skill_percent_count": percent_count(share, n, "niños"),
            "skill_count_percent": count_percent(n, share, thousands=True),
        }
    )


def skill_level_rows(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """One row per skill level: filled ids against all levels, as a label."""
    level = "Nivel_de_logro__c"
    out = M.share_of_rows(t["skills"], ctx, level, counted="DNI__c")
    by = [c for c in ctx.by if c != level]
    share = divide(F.col("part"), F.col("whole"), 0)
    return out.select(*by, level, count_percent(F.col("part"), share, thousands=True).alias("skill_rows_label"))


def skill_results(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    level, filled = F.col("Nivel_de_logro__c"), F.col("DNI__c").isNotNull()
    return M.aggregate(
        t["skills"],
        ctx,
        achieved=F.count_if(filled & (level == "Logrado")),
        outstanding=M.count_where(filled & (level == "Sobresaliente")),
    )


def level_name(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Level shown for a group: the largest one, where several are selected."""
    return M.aggregate(t["skills"], ctx, level_label_fixed=F.max("Nivel_de_logro__c"))


# --- workshops and hours -----------------------------------------------------------------


def experiential_children(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Children with an attended activity (the report holds a typed-in number instead)."""
    return M.distinct_counts(
        t["experiential"], ctx, "DNI__c", experiential_children=F.col("VALOR__c") == s.attended
    )


def experiential_events(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Dated activities that somebody attended (the report holds a typed-in number instead)."""
    df = t["experiential"].withColumn("_event", F.struct("FECHA__c", "ACTIVIDAD__c"))
    return M.distinct_counts(df, ctx, "_event", experiential_events=F.col("VALOR__c") == s.attended)


def hours_total(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    return M.aggregate(t["hours"], ctx, learning_hours=F.sum("Valor"))


def hours_for_centre(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Per group: hours of its one centre, or all hours when it has none or several."""
    return M.sum_for_selected(
        t["hours"], "Valor", "Nombre_Limpio", ctx.apply(t["attendance"]), "Centro_Limpio", "learning_hours_selected", ctx.by
    )


def hours_by_centre(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Hours per centre among the centres that attendance holds."""
    kept = keep_values_of(t["hours"], "Nombre_Limpio", ctx.apply(t["attendance"]), "Centro_Limpio")
    return kept.groupBy("Nombre_Limpio").agg(F.sum("Valor").alias("learning_hours_selected"))


# --- impact ------------------------------------------------------------------------------


def _impact(table: str, cuts: tuple[int, int], suffix: str):
    def build(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
        return M.cumulative_distinct(
            t[table],
            ctx,
            "DNI__c",
            "FECHA__c",
            {
                f"active{suffix}": _status("ACTIVO"),
                f"inactive{suffix}": _status("INACTIVO"),
                f"impacted{suffix}": _status("ACTIVO", "INACTIVO"),
            },
            {f"cut{c}": s.cuts.get(c) for c in cuts},
        )

    return build


impact_regular = _impact("attendance", (1, 2), "")
impact_extra = _impact("extra", (3, 4), "_extra")


def _slicer(table: str, cuts: tuple[int, int], suffix: str):
    def build(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
        return slicer_rows(_impact(table, cuts, suffix)(t, ctx, s), ctx, s, cuts, suffix)

    return build


def slicer_rows(impact: DataFrame, ctx: FilterContext, s: Settings, cuts: tuple[int, int], suffix: str) -> DataFrame:
    """Impact measures under the labels of the slicer, with the change between the cuts."""
    a, b = cuts
    names = {"impactados": "impacted", "activos": "active", "inactivos": "inactive"}
    rows = {K.SLICER_ROWS[k]: [f"{m}{suffix}_cut{a}", f"{m}{suffix}_cut{b}"] for k, m in names.items()}
    out = M.pick_by_slicer(impact, ctx, rows, [f"value_cut{a}", f"value_cut{b}"])
    if s.slicer_row is not None:
        out = out.filter(F.col("fila") == s.slicer_row)
    return out.withColumn(f"change_{a}{b}", change(F.col(f"value_cut{a}"), F.col(f"value_cut{b}")))


slicer_regular = _slicer("attendance", (1, 2), "")
slicer_extra = _slicer("extra", (3, 4), "_extra")


def letter_check(t: Tables, ctx: FilterContext, s: Settings) -> DataFrame:
    """Seventh letter of a site name, one row per site of the hours table."""
    return t["hours"].select("Nombre_Limpio", substring_at(F.col("Nombre_Limpio"), 7).alias("letter"))


# --- catalogue ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """A builder, the measures it gives (number -> column) and its extra grouping columns."""

    build: Callable[[Tables, FilterContext, Settings], DataFrame]
    measures: Mapping[str, str]
    own: tuple[str, ...] = ()


BLOCKS: tuple[Block, ...] = (
    Block(attendance_counts, {"1.1": "attendances"}),
    Block(extra_counts, {"1.2": "extra_attendances"}),
    Block(attendance_to_cuts, {"1.3": "attended_cut1", "1.4": "attended_cut2", "7.19": "attended_change_12"}),
    Block(extra_to_cuts, {"1.5": "attended_cut3", "1.6": "attended_cut4", "7.20": "attended_change_34"}),
    Block(attendance_by_child, {"1.7": "attendance_ratio"}, ("DNI__c",)),
    Block(attendance_mean, {"1.8": "mean_attendance"}),
    Block(absence_means, {"1.9": "absence_rate", "1.10": "excused_rate"}),
    Block(class_days, {"1.11": "class_days"}),
    Block(
        children,
        {
            "2.1": "children_total",
            "2.2": "active_children",
            "2.3": "inactive_children",
            "2.13": "retention_rate",
            "2.14": "dropout_rate",
        },
    ),
    Block(extra_children, {"2.4": "extra_children_total"}),
    Block(disability, {"2.5": "children_with_disability"}),
    Block(social_rows, {"2.6": "children_in_social_record"}),
    Block(newest_children, {"2.7": "joined_last_month"}),
    Block(month_changes, {"2.8": "new_active", "2.9": "new_inactive", "2.10": "impacted_in_month"}),
    Block(status_dates, {"2.11": "activation_date", "2.12": "dropout_date"}, ("DNI__c",)),
    Block(guardians, {"2.15": "guardians"}),
    Block(families, {"2.16": "families"}),
    Block(
        evaluated,
        {"3.1": "evaluated_children", "3.10": "graded_first", "3.11": "graded_second", "3.12": "graded_change"},
    ),
    Block(evaluated_total, {"3.2": "evaluated_overall"}),
    Block(
        grade_levels,
        {"3.3": "level_share", "3.4": "level_children", "8.1": "level_label"},
        ("NIVEL_DE_LOGRO__c",),
    ),
    Block(
        area_means,
        {
            "3.5": "mean_science",
            "3.6": "mean_communication",
            "3.7": "mean_mathematics",
            "3.8": "mean_social",
            "3.9": "mean_technology",
        },
    ),
    Block(
        competence_counts,
        {"3.13": "competences_first", "3.14": "competences_second", "3.15": "competences_change"},
    ),
    Block(topics, {"3.16": "topics_in_area"}),
    Block(curriculum_label, {"3.17": "curriculum_label"}),
    Block(child_satisfaction, {f"4.{i}": f"child_question_{i}" for i in range(1, 6)}),
    Block(survey_parents, {"4.6": "answering_parents"}),
    Block(survey_children, {"4.7": "children_of_answering"}),
    Block(_answer_label("improved_school", "improved_label"), {"4.8": "improved_label"}),
    Block(_answer_label("learned_by_playing", "learned_label"), {"4.9": "learned_label"}),
    Block(
        answers,
        {"4.10": "answer", "4.11": "answer_level", "4.13": "answer_legend", "4.14": "unified_level"},
    ),
    Block(survey_rows, {"4.12": "answers"}),
    Block(level_rows, {"4.15": "answers_at_level"}, ("unified_level",)),
    Block(
        indicator_shares,
        {"4.16": "indicator_share_1", "4.17": "indicator_share_3", "4.18": "indicator_share_4"},
    ),
    Block(workshop_children, {"5.1": "skill_children"}),
    Block(
        skill_levels,
        {
            "5.2": "skill_level_share",
            "5.3": "skill_level_children",
            "5.6": "skill_percent_count",
            "5.7": "skill_count_percent",
        },
        ("Nivel_de_logro__c",),
    ),
    Block(skill_results, {"5.4": "achieved", "5.5": "outstanding"}),
    Block(level_name, {"5.8": "level_label_fixed"}),
    Block(skill_level_rows, {"5.9": "skill_rows_label"}, ("Nivel_de_logro__c",)),
    Block(extra_days, {"6.1": "extra_workshops"}),
    Block(experiential_children, {"6.2": "experiential_children"}),
    Block(experiential_events, {"6.3": "experiential_events"}),
    Block(hours_total, {"6.4": "learning_hours"}),
    Block(hours_for_centre, {"6.5": "learning_hours_selected"}),
    Block(
        impact_regular,
        {
            "7.1": "active_cut1",
            "7.2": "inactive_cut1",
            "7.3": "impacted_cut1",
            "7.4": "active_cut2",
            "7.5": "inactive_cut2",
            "7.6": "impacted_cut2",
        },
    ),
    Block(
        impact_extra,
        {
            "7.7": "active_extra_cut3",
            "7.8": "inactive_extra_cut3",
            "7.9": "impacted_extra_cut3",
            "7.10": "active_extra_cut4",
            "7.11": "inactive_extra_cut4",
            "7.12": "impacted_extra_cut4",
        },
    ),
    Block(slicer_regular, {"7.13": "value_cut1", "7.14": "value_cut2", "7.17": "change_12"}, ("fila",)),
    Block(slicer_extra, {"7.15": "value_cut3", "7.16": "value_cut4", "7.18": "change_34"}, ("fila",)),
    Block(letter_check, {"8.4": "letter"}),
)

MEASURES: dict[str, tuple[Block, str]] = {
    number: (block, column) for block in BLOCKS for number, column in block.measures.items()
}


def measure(number: str, tables: Tables, ctx: FilterContext | None = None, settings: Settings | None = None) -> DataFrame:
    """One measure by its number: grouping columns and the measure's column."""
    block, column = MEASURES[number]
    out = block.build(tables, ctx or FilterContext(), settings or Settings())
    drop = [c for n, c in block.measures.items() if c != column]
    return out.drop(*drop)


def evaluate(
    numbers: Sequence[str], tables: Tables, ctx: FilterContext | None = None, settings: Settings | None = None
) -> DataFrame:
    """Several measures in long form: group columns, measure number and name, value.

    Each block is built once for all its measures. Values are text, since measures differ in
    type; numbers keep full precision.
    """
    ctx, settings = ctx or FilterContext(), settings or Settings()
    chosen: dict[int, tuple[Block, list[str]]] = {}
    for number in numbers:
        block, _ = MEASURES[number]
        chosen.setdefault(id(block), (block, []))[1].append(number)
    return union_aligned([in_long_form(b, b.build(tables, ctx, settings), wanted, ctx) for b, wanted in chosen.values()])


def in_long_form(block: Block, built: DataFrame, wanted: Sequence[str], ctx: FilterContext) -> DataFrame:
    """A block's wanted measures as rows: group columns, number, measure, value."""
    names = set(block.measures.values())
    groups = [c for c in built.columns if c not in names and c in (*ctx.by, *block.own)]
    lines = F.array(
        *[
            F.struct(
                F.lit(n).alias("number"),
                F.lit(block.measures[n]).alias("measure"),
                F.col(block.measures[n]).cast("string").alias("value"),
            )
            for n in wanted
        ]
    )
    return built.select(*groups, F.inline(lines))


def kpi_report(tables: Tables, settings: Settings | None = None) -> DataFrame:
    """Headline measures against their targets: value, target, reached.

    Each figure is reported when its table is given: children, retention and attendance from
    ``attendance``; the share of evaluated children at one of ``settings.reached_levels`` from
    ``grades``; the mean of the five questions from ``children_satisfaction``; the share of
    skill results achieved or outstanding from ``skills``.
    """
    s = settings or Settings()
    ctx = FilterContext()

    def line(kpi: str, value: Column) -> Column:
        return F.struct(F.lit(kpi).alias("kpi"), value.cast("double").alias("value"))

    frames = []
    if "attendance" in tables:
        rates = (line(k, F.col(k)) for k in ("children_total", "retention_rate"))
        frames.append(children(tables, ctx, s).select(F.inline(F.array(*rates))))
        mean = line("mean_attendance", F.col("mean_attendance"))
        frames.append(attendance_mean(tables, ctx, s).select(F.inline(F.array(mean))))
    if "grades" in tables:
        reached = F.col("NIVEL_DE_LOGRO__c").isin(*s.reached_levels)
        counts = M.distinct_counts(tables["grades"], ctx, "DNI__c", reached=reached, everybody=F.lit(True))
        share = line("level_share", divide(F.col("reached"), F.col("everybody")))
        frames.append(counts.select(F.inline(F.array(share))))
    if "children_satisfaction" in tables:
        means = F.array(*[F.col(f"child_question_{i}") for i in range(1, 6)])
        filled = F.filter(means, lambda x: x.isNotNull())
        total = F.aggregate(filled, F.lit(0.0), lambda a, x: a + x)
        overall = line("child_satisfaction", divide(total, F.size(filled)))
        frames.append(child_satisfaction(tables, ctx, s).select(F.inline(F.array(overall))))
    if "skills" in tables:
        level, filled_id = F.col("Nivel_de_logro__c"), F.col("DNI__c").isNotNull()
        good = F.count_if(filled_id & level.isin("Logrado", "Sobresaliente"))
        share = line("skill_share", divide(good, F.count("DNI__c")))
        frames.append(tables["skills"].agg(share.alias("k")).select("k.*"))
    targets = F.create_map(*[F.lit(x) for pair in K.KPI_TARGETS.items() for x in pair])
    target = targets[F.col("kpi")]
    return union_aligned(frames).select("kpi", "value", target.alias("target"), (F.col("value") > target).alias("reached"))
