"""A dashboard page in one pass per table.

Measures that have a recipe here are finished from values gathered once per (group, child) or
(group, day); the others are built by their block. Results equal those of ``dashboard.evaluate``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.functions.numbers import divide
from aulario.operators import measures as M
from aulario.operators.combine import union_aligned
from aulario.operators.fused import finish, gather
from aulario.operators.measures import FilterContext, blank
from aulario.plans import dashboard as D
from aulario.plans.dashboard import Settings, Tables

CHILD, DAY = "DNI__c", "FECHA__c"


@dataclass(frozen=True)
class Scope:
    """Conditions and choices that ingredients are made of."""

    here: Column
    undated: Column
    settings: Settings


@dataclass(frozen=True)
class Recipe:
    """How a block is finished: its table, ingredients, the last step from rows per key, and that key."""

    table: str
    needs: tuple[str, ...]
    finish: Callable[[DataFrame, FilterContext, Settings], DataFrame]
    key: str = CHILD


def scope(df: DataFrame, ctx: FilterContext, s: Settings) -> Scope:
    def holds(some: FilterContext) -> Column:
        return F.coalesce(some.condition(df), F.lit(False))

    return Scope(holds(ctx), holds(ctx.without(DAY)), s)


def _status(*values: str) -> Column:
    return F.coalesce(F.col("TIPO_ALUMNO__c").isin(*values), F.lit(False))


def _mark(value: str) -> Column:
    return F.coalesce(F.col("ASISTENCIA__c") == value, F.lit(False))


_STATUSES = {"active": ("ACTIVO",), "inactive": ("INACTIVO",), "impacted": ("ACTIVO", "INACTIVO")}


def _to_cut(c: Scope, cut: int) -> Column:
    return F.count_if(c.undated & _mark("A") & (F.col(DAY) <= F.lit(c.settings.cuts.get(cut)).cast("date")))


def _term(c: Scope, half: str) -> Column:
    return F.coalesce(F.col("EVALUACION__c") == f"{c.settings.year}-{half}", F.lit(False))


def _areas(s: Settings) -> dict[str, str]:
    return {
        "mean_science": s.science_area,
        "mean_communication": "Comunicación",
        "mean_mathematics": "Matemática",
        "mean_social": s.social_area,
        "mean_technology": "Tecnología",
    }


def _area_value(c: Scope, name: str) -> Column:
    return F.when(c.here & (F.col("REA__c") == _areas(c.settings)[name]), F.col("Valor_Promedio__c"))


INGREDIENTS: dict[str, Callable[[Scope], Column]] = {
    "rows": lambda c: F.count_if(c.here),
    "rows_undated": lambda c: F.count_if(c.undated),
    "attended": lambda c: F.count_if(c.here & _mark("A")),
    "absent": lambda c: F.count_if(c.here & _mark("F")),
    "excused": lambda c: F.count_if(c.here & _mark("FJ")),
    **{f"cut{i}": (lambda c, i=i: _to_cut(c, i)) for i in (1, 2, 3, 4)},
    "actual": lambda c: F.max("A_REALES__c"),
    "expected": lambda c: F.max("A_ESPERADAS__c"),
    "expected_here": lambda c: F.max(F.when(c.here, F.col("A_ESPERADAS__c"))),
    **{f"is_{n}": (lambda c, v=v: F.bool_or(c.here & _status(*v))) for n, v in _STATUSES.items()},
    **{f"first_{n}": (lambda c, v=v: F.min(F.when(_status(*v), F.col(DAY)))) for n, v in _STATUSES.items()},
    **{f"first_{n}_undated": (lambda c, v=v: F.min(F.when(c.undated & _status(*v), F.col(DAY)))) for n, v in _STATUSES.items()},
    "last_here": lambda c: F.max(F.when(c.here, F.col(DAY))),
    "joined": lambda c: F.max("F_INCORPORACION__c"),
    "joined_here": lambda c: F.max(F.when(c.here, F.col("F_INCORPORACION__c"))),
    "first_term": lambda c: F.bool_or(c.here & _term(c, "I")),
    "second_term": lambda c: F.bool_or(c.here & _term(c, "II")),
    "competences_1": lambda c: F.count_if(c.here & F.col("Competencia_texto__c").isNotNull() & _term(c, "I")),
    "competences_2": lambda c: F.count_if(c.here & F.col("Competencia_texto__c").isNotNull() & _term(c, "II")),
    **{f"sum_{n}": (lambda c, n=n: F.sum(_area_value(c, n))) for n in _areas(Settings())},
    **{f"count_{n}": (lambda c, n=n: F.count(_area_value(c, n))) for n in _areas(Settings())},
}


def _blank_sum(name: str) -> Column:
    return blank(F.sum(name))


def _counted(column: str, name: str):
    return lambda p, ctx, s: finish(p, ctx.by, "rows", **{name: _blank_sum(column)})


def _cuts(cuts: tuple[int, int], change: str):
    names = [f"attended_cut{c}" for c in cuts]

    def run(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
        out = finish(p, ctx.by, "rows_undated", **{n: _blank_sum(f"cut{c}") for n, c in zip(names, cuts)})
        return M.relative_change(out, *names, change)

    return run


def _by_child(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    return p.groupBy(F.col("_key").alias(CHILD)).agg(divide(F.max("actual"), F.max("expected")).alias("attendance_ratio"))


def _mean(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    n, d = F.col("actual"), F.col("expected")
    if ctx.by:
        whole = M.Window.partitionBy("_key")
        n, d = F.max("actual").over(whole), F.max("expected").over(whole)
    told = p.withColumn("_ratio", divide(n, d)).filter("rows > 0")
    return finish(told, ctx.by, "rows", mean_attendance=F.avg("_ratio"))


def _absences(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    rates = {n: F.avg(divide(blank(F.col(c)), F.col("expected_here"))) for n, c in (("absence_rate", "absent"), ("excused_rate", "excused"))}
    return finish(p, ctx.by, "rows", **rates)


def _days(name: str):
    return lambda p, ctx, s: finish(p, ctx.by, "rows", **{name: blank(F.count_if(F.col("rows") > 0))})


def _children(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    out = finish(p, ctx.by, "rows", **{n: F.count_if(F.col(f"is_{n}")) for n in _STATUSES})
    active, inactive, total = blank(F.col("active")), blank(F.col("inactive")), F.col("impacted")
    return out.select(
        *ctx.by,
        total.alias("children_total"),
        active.alias("active_children"),
        inactive.alias("inactive_children"),
        divide(active, total).alias("retention_rate"),
        divide(inactive, total).alias("dropout_rate"),
    )


def _newest(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    latest = p.select(F.max("joined")).scalar()
    joined = F.col("joined_here") >= F.trunc(latest, "month")
    return finish(p.withColumn("_new", joined), ctx.by, "rows", joined_last_month=blank(F.count_if("_new")))


def _month_changes(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    told = p.select(
        *ctx.by,
        "_key",
        F.col("first_active").alias("new_active"),
        F.col("first_inactive").alias("new_inactive"),
        F.col("last_here").alias("_last"),
        (F.col("rows") > 0).alias("_here"),
    )
    out = M.firsts_in_last_month(told, ctx.by, ["new_active", "new_inactive"])
    return out.withColumn("impacted_in_month", M.add(F.col("new_active"), F.col("new_inactive")))


def _status_dates(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    return p.groupBy(F.col("_key").alias(CHILD)).agg(
        F.min("first_active").alias("activation_date"), F.min("first_inactive").alias("dropout_date")
    )


def _impact(cuts: tuple[int, int], suffix: str):
    def run(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
        columns = {
            f"{n}{suffix}_cut{c}": blank(F.count_if(F.col(f"first_{n}_undated") <= F.lit(s.cuts.get(c)).cast("date")))
            for n in _STATUSES
            for c in cuts
        }
        return finish(p, ctx.by, "rows_undated", **columns)

    return run


def _slicer(cuts: tuple[int, int], suffix: str):
    return lambda p, ctx, s: D.slicer_rows(_impact(cuts, suffix)(p, ctx, s), ctx, s, cuts, suffix)


def _evaluated(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    out = finish(
        p,
        ctx.by,
        "rows",
        evaluated_children=blank(F.count_if(F.col("rows") > 0)),
        graded_first=blank(F.count_if("first_term")),
        graded_second=blank(F.count_if("second_term")),
    )
    return M.relative_change(out, "graded_first", "graded_second", "graded_change")


def _evaluated_total(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    every = p.groupBy("_key").agg(F.lit(1).alias("_one")).agg(F.count("_one").alias("n"))
    return finish(p, ctx.by, "rows").withColumn("evaluated_overall", every.scalar())


def _area_means(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    return finish(p, ctx.by, "rows", **{n: divide(F.sum(f"sum_{n}"), F.sum(f"count_{n}")) for n in _areas(s)})


def _competences(p: DataFrame, ctx: FilterContext, s: Settings) -> DataFrame:
    out = finish(p, ctx.by, "rows", competences_first=_blank_sum("competences_1"), competences_second=_blank_sum("competences_2"))
    return M.relative_change(out, "competences_first", "competences_second", "competences_change")


_FIRSTS = tuple(f"first_{n}_undated" for n in _STATUSES)
_AREA_NEEDS = tuple(f"{kind}_{n}" for kind in ("sum", "count") for n in _areas(Settings()))

RECIPES: Mapping[Callable, Recipe] = {
    D.attendance_counts: Recipe("attendance", ("rows", "attended"), _counted("attended", "attendances")),
    D.attendance_to_cuts: Recipe("attendance", ("rows_undated", "cut1", "cut2"), _cuts((1, 2), "attended_change_12")),
    D.attendance_by_child: Recipe("attendance", ("actual", "expected"), _by_child),
    D.attendance_mean: Recipe("attendance", ("rows", "actual", "expected"), _mean),
    D.absence_means: Recipe("attendance", ("rows", "absent", "excused", "expected_here"), _absences),
    D.class_days: Recipe("attendance", ("rows",), _days("class_days"), DAY),
    D.children: Recipe("attendance", ("rows", *(f"is_{n}" for n in _STATUSES)), _children),
    D.newest_children: Recipe("attendance", ("rows", "joined", "joined_here"), _newest),
    D.month_changes: Recipe("attendance", ("rows", "first_active", "first_inactive", "last_here"), _month_changes),
    D.status_dates: Recipe("attendance", ("first_active", "first_inactive"), _status_dates),
    D.impact_regular: Recipe("attendance", ("rows_undated", *_FIRSTS), _impact((1, 2), "")),
    D.slicer_regular: Recipe("attendance", ("rows_undated", *_FIRSTS), _slicer((1, 2), "")),
    D.extra_counts: Recipe("extra", ("rows", "attended"), _counted("attended", "extra_attendances")),
    D.extra_to_cuts: Recipe("extra", ("rows_undated", "cut3", "cut4"), _cuts((3, 4), "attended_change_34")),
    D.extra_children: Recipe(
        "extra", ("rows", "is_impacted"), lambda p, ctx, s: finish(p, ctx.by, "rows", extra_children_total=F.count_if("is_impacted"))
    ),
    D.extra_days: Recipe("extra", ("rows",), _days("extra_workshops"), DAY),
    D.impact_extra: Recipe("extra", ("rows_undated", *_FIRSTS), _impact((3, 4), "_extra")),
    D.slicer_extra: Recipe("extra", ("rows_undated", *_FIRSTS), _slicer((3, 4), "_extra")),
    D.evaluated: Recipe("grades", ("rows", "first_term", "second_term"), _evaluated),
    D.evaluated_total: Recipe("grades", ("rows",), _evaluated_total),
    D.area_means: Recipe("grades", ("rows", *_AREA_NEEDS), _area_means),
    D.competence_counts: Recipe("grades", ("rows", "competences_1", "competences_2"), _competences),
}


def page_ingredients(
    table: str, df: DataFrame, blocks: Sequence[D.Block], ctx: FilterContext, s: Settings
) -> tuple[list[str], dict[str, Column]]:
    """Keys and ingredients that the blocks on one table need together."""
    recipes = [RECIPES[b.build] for b in blocks if b.build in RECIPES and RECIPES[b.build].table == table]
    c = scope(df, ctx, s)
    return sorted({r.key for r in recipes}), {n: INGREDIENTS[n](c) for r in recipes for n in r.needs}


def evaluate_page(
    numbers: Sequence[str], tables: Tables, ctx: FilterContext | None = None, settings: Settings | None = None
) -> DataFrame:
    """As ``dashboard.evaluate``: group columns, measure number and name, value; one scan per table with recipes."""
    ctx, s = ctx or FilterContext(), settings or Settings()
    wanted: dict[int, tuple[D.Block, list[str]]] = {}
    for number in numbers:
        block, _ = D.MEASURES[number]
        wanted.setdefault(id(block), (block, []))[1].append(number)
    blocks = [b for b, _ in wanted.values()]
    gathered: dict[str, dict[str, DataFrame]] = {}
    for table in dict.fromkeys(RECIPES[b.build].table for b in blocks if b.build in RECIPES):
        keys, ingredients = page_ingredients(table, tables[table], blocks, ctx, s)
        gathered[table] = gather(tables[table], ctx.by, keys, ingredients)
    frames = []
    for block, some in wanted.values():
        recipe = RECIPES.get(block.build)
        if recipe is None:
            built = block.build(tables, ctx, s)
        else:
            built = recipe.finish(gathered[recipe.table][recipe.key], ctx, s)
        frames.append(D.in_long_form(block, built, some, ctx))
    return union_aligned(frames)
