"""Measure families: counts, distinct counts, ratios, shares, cut-offs, cohorts.

A measure is an aggregate of a table under a filter context, grouped by the columns of the
visual (``by``). Counts of nothing are blank (null), as in the report language; a measure
that shows 0 instead says so. Distinct counts first reduce the table to one row per group
and key with a flag per condition, which any number of measures then share: one shuffle,
pre-aggregated on each task, instead of one expanded copy of the rows per distinct count.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.numbers import change, divide
from aulario.operators.joins import join_null_safe


@dataclass(frozen=True)
class FilterContext:
    """Grouping columns plus filters by column name, so a measure can ignore some of them.

    ``filters`` maps a column name to a function from that column to a condition.
    """

    by: tuple[str, ...] = ()
    filters: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)

    def without(self, *columns: str) -> "FilterContext":
        """Ignore the filters on some columns."""
        return FilterContext(self.by, {k: f for k, f in self.filters.items() if k not in columns})

    def only(self, *columns: str) -> "FilterContext":
        """Ignore the filters on all but some columns."""
        return FilterContext(self.by, {k: f for k, f in self.filters.items() if k in columns})

    def none(self) -> "FilterContext":
        """Ignore every filter."""
        return FilterContext(self.by)

    def condition(self, df: DataFrame) -> Column:
        """All filters on columns the table has, as one condition."""
        terms = [f(F.col(f"`{c}`")) for c, f in self.filters.items() if c in df.columns]
        return reduce(lambda a, b: a & b, terms, F.lit(True))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition(df)) if self.filters else df


def blank(n: Column) -> Column:
    """A count of nothing is blank."""
    return F.nullif(n, F.lit(0).cast("bigint"))


def add(a: Column, b: Column) -> Column:
    """Sum in which a blank counts as zero and two blanks stay blank."""
    zero = F.lit(0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) + F.coalesce(b, zero))


def aggregate(df: DataFrame, ctx: FilterContext, **columns: Column) -> DataFrame:
    """Plain aggregates (counts, sums, means) per group, all in one pass."""
    return ctx.apply(df).groupBy(*ctx.by).agg(*[c.alias(n) for n, c in columns.items()])


def count_where(condition: Column) -> Column:
    """Filtered row count, blank when nothing matches."""
    return blank(F.count_if(condition))


def distinct_counts(
    df: DataFrame, ctx: FilterContext, key: str, count_null: bool = True, **conditions: Column
) -> DataFrame:
    """Distinct keys per group under each condition; a null key counts as a value.

    Result columns are plain counts (0 when nothing matches); wrap in :func:`blank` to show
    nothing instead.
    """
    per_key = (
        ctx.apply(df)
        .groupBy(*ctx.by, F.col(key).alias("_key"))
        .agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])
    )
    if not count_null:
        per_key = per_key.filter(F.col("_key").isNotNull())
    return per_key.groupBy(*ctx.by).agg(*[F.count_if(F.col(n)).alias(n) for n in conditions])


def cumulative_counts(
    df: DataFrame, ctx: FilterContext, date: str, **cuts: tuple[Column, dt.date | None]
) -> DataFrame:
    """Rows matching a condition up to a cut-off date, ignoring the filter on the date."""
    return aggregate(
        df,
        ctx.without(date),
        **{n: count_where(c & (F.col(date) <= F.lit(cut).cast("date"))) for n, (c, cut) in cuts.items()},
    )


def cumulative_distinct(
    df: DataFrame,
    ctx: FilterContext,
    key: str,
    date: str,
    statuses: Mapping[str, Column],
    cuts: Mapping[str, dt.date | None],
) -> DataFrame:
    """Distinct keys with a status up to each cut-off date; columns ``<status>_<cut>``.

    A key counts at a cut when its first date with the status is not later, so one pass to
    the first date per key answers every status and cut.
    """
    day = F.col(date)
    firsts = (
        ctx.without(date)
        .apply(df)
        .groupBy(*ctx.by, F.col(key).alias("_key"))
        .agg(*[F.min(F.when(c, day)).alias(f"_{s}") for s, c in statuses.items()])
    )
    return firsts.groupBy(*ctx.by).agg(
        *[
            blank(F.count_if(F.col(f"_{s}") <= F.lit(cut).cast("date"))).alias(f"{s}_{name}")
            for s in statuses
            for name, cut in cuts.items()
        ]
    )


def ratio_per_key(df: DataFrame, key: str, numerator: str, denominator: str, name: str) -> DataFrame:
    """Largest numerator over largest denominator per key, over the whole table."""
    return df.groupBy(key).agg(divide(F.max(numerator), F.max(denominator)).alias(name))


def mean_ratio_over_keys(
    df: DataFrame, ctx: FilterContext, key: str, numerator: str, denominator: str, name: str
) -> DataFrame:
    """Mean over the keys in context of a ratio taken over all rows of the key.

    The ratio ignores every filter but the key; blanks are left out of the mean.
    """
    per_group = df.groupBy(*ctx.by, F.col(key).alias("_key")).agg(
        F.max(numerator).alias("_n"),
        F.max(denominator).alias("_d"),
        F.bool_or(F.coalesce(ctx.condition(df), F.lit(False))).alias("_here"),
    )
    if ctx.by:
        # One row per group and key is left, so a key's partition holds its groups only.
        whole = Window.partitionBy("_key")
        per_group = per_group.withColumn("_n", F.max("_n").over(whole)).withColumn("_d", F.max("_d").over(whole))
    ratio = divide(F.col("_n"), F.col("_d"))
    return per_group.filter("_here").groupBy(*ctx.by).agg(F.avg(ratio).alias(name))


def mean_rate_over_keys(
    df: DataFrame, ctx: FilterContext, key: str, denominator: str, **conditions: Column
) -> DataFrame:
    """Mean over keys of (rows matching) / (largest denominator), both within context.

    A key without a matching row has a blank rate and is left out of that mean.
    """
    per_key = (
        ctx.apply(df)
        .groupBy(*ctx.by, F.col(key).alias("_key"))
        .agg(F.max(denominator).alias("_d"), *[count_where(c).alias(n) for n, c in conditions.items()])
    )
    return per_key.groupBy(*ctx.by).agg(
        *[F.avg(divide(F.col(n), F.col("_d"))).alias(n) for n in conditions]
    )


def _with_whole(part: DataFrame, whole: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Attach a total per group (or the single overall total) to the parts."""
    if by:
        return join_null_safe(part, whole, by, "left", spread=False)
    return part.withColumn(name, whole.select(name).scalar())


def share_of_distinct(
    df: DataFrame,
    ctx: FilterContext,
    over: str,
    key: str,
    part: str = "part",
    whole: str = "whole",
    share: str = "share",
    keep_filter: bool = False,
) -> DataFrame:
    """Distinct keys per value of ``over``, against all distinct keys ignoring that column.

    The filter on ``over`` limits the parts only, unless ``keep_filter`` is set: then the whole
    ignores just the grouping by that column and keeps what a slicer has chosen. A key may hold
    several values, so the whole is counted again from (group, key) pairs and never added up
    from the parts.
    """
    by = [c for c in ctx.by if c != over]
    # Every row stands once under its value and once under the whole, so that one scan and
    # one shuffle count both.
    nothing = F.lit(None).cast(df.schema[over].dataType)
    sides = F.array(
        F.struct(F.lit(False).alias("_whole"), F.col(over).alias(over)),
        F.struct(F.lit(True).alias("_whole"), nothing.alias(over)),
    )
    scope = ctx if keep_filter else ctx.without(over)
    rows = scope.apply(df).select(*by, F.col(key).alias("_key"), F.inline(sides))
    pairs = rows.groupBy(*by, "_whole", over, "_key").agg(F.lit(1).alias("_one"))
    counts = pairs.groupBy(*by, "_whole", over).agg(F.count("_one").alias(part))
    if by:
        total = F.max(F.when(F.col("_whole"), F.col(part))).over(Window.partitionBy(*by))
        parts = counts.withColumn(whole, total).filter(~F.col("_whole")).drop("_whole")
    else:
        total = counts.filter("_whole").select(F.col(part)).scalar()
        parts = counts.filter(~F.col("_whole")).drop("_whole").withColumn(whole, total)
    if over in ctx.filters:
        parts = parts.filter(ctx.filters[over](F.col(over)))
    return parts.withColumn(share, divide(F.col(part), F.col(whole), 0))


def share_of_rows(
    df: DataFrame,
    ctx: FilterContext,
    over: str,
    counted: str | None = None,
    part: str = "part",
    whole: str = "whole",
    share: str = "share",
) -> DataFrame:
    """Rows (or filled values of ``counted``) per value of ``over`` against all in the group."""
    by = [c for c in ctx.by if c != over]
    n = F.count(F.lit(1) if counted is None else F.col(counted))
    every = ctx.without(over).apply(df).groupBy(*by, over).agg(n.alias(part))
    wholes = every.groupBy(*by).agg(F.sum(part).alias(whole))
    parts = every.filter(ctx.filters[over](F.col(over))) if over in ctx.filters else every
    return _with_whole(parts, wholes, by, whole).withColumn(share, divide(F.col(part), F.col(whole)))


def share_keeping(
    df: DataFrame, ctx: FilterContext, keep: Sequence[str], part: str = "part", whole: str = "whole", share: str = "share"
) -> DataFrame:
    """Rows in context against the rows that remain when only the kept columns filter."""
    kept = [c for c in ctx.by if c in keep]
    base = ctx.only(*keep).apply(df)
    groups = base.groupBy(*ctx.by).agg(
        F.count_if(ctx.condition(df)).alias(part), F.count(F.lit(1)).alias("_all")
    )
    wholes = groups.groupBy(*kept).agg(F.sum("_all").alias(whole))
    parts = groups.filter(F.col(part) > 0).drop("_all")
    return _with_whole(parts, wholes, kept, whole).withColumn(share, divide(F.col(part), F.col(whole)))


def total_ignoring_filters(df: DataFrame, ctx: FilterContext, key: str, name: str, part: str) -> DataFrame:
    """Distinct keys per group beside the distinct keys of the whole table, every filter off."""
    parts = distinct_counts(df, ctx, key, **{part: F.lit(True)})
    whole = distinct_counts(df, FilterContext(), key, **{name: F.lit(True)})
    return parts.withColumn(name, whole.scalar())


def first_dates(df: DataFrame, key: str, date: str, **statuses: Column) -> DataFrame:
    """First date of each key with each status, over the whole table."""
    return df.groupBy(key).agg(*[F.min(F.when(c, F.col(date))).alias(n) for n, c in statuses.items()])


def first_in_current_month(
    df: DataFrame, ctx: FilterContext, key: str, date: str, **statuses: Column
) -> DataFrame:
    """Keys in context whose first date with a status falls in the group's latest month.

    The first date is taken over all rows of the key, the latest month over the group in
    context. Keys are counted per month first; a group then looks up its latest month.
    """
    here = F.coalesce(ctx.condition(df), F.lit(False))
    day = F.col(date)
    per_key = df.groupBy(*ctx.by, F.col(key).alias("_key")).agg(
        *[F.min(F.when(c, day)).alias(n) for n, c in statuses.items()],
        F.max(F.when(here, day)).alias("_last"),
        F.bool_or(here).alias("_here"),
    )
    return firsts_in_last_month(per_key, ctx.by, list(statuses))


def firsts_in_last_month(per_key: DataFrame, by: Sequence[str], statuses: Sequence[str]) -> DataFrame:
    """The same from rows per group and ``_key``: first dates, ``_last`` date in context, whether ``_here``."""
    if by:
        whole = Window.partitionBy("_key")
        per_key = per_key.withColumns({n: F.min(n).over(whole) for n in statuses})
    events = F.array(
        *[
            F.struct(F.lit(n).alias("_status"), F.trunc(F.col(n), "month").alias("_month"))
            for n in statuses
        ]
    )
    monthly = (
        per_key.filter("_here")
        .select(*by, "_last", F.inline(events))
        .groupBy(*by, "_status", "_month")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_last").alias("_last"))
    )
    label = F.concat_ws(" ", F.col("_status"), F.col("_month").cast("string"))
    counted = F.when(F.col("_month").isNotNull(), F.struct(label, "_n"))
    months = monthly.groupBy(*by).agg(
        F.max("_last").alias("_last"), F.map_from_entries(F.collect_list(counted)).alias("_counts")
    )
    current = F.trunc(F.col("_last"), "month").cast("string")
    return months.select(
        *by, *[F.col("_counts")[F.concat_ws(" ", F.lit(n), current)].alias(n) for n in statuses]
    )


def last_month_cohort(df: DataFrame, ctx: FilterContext, key: str, date: str, name: str) -> DataFrame:
    """Distinct keys dated in the month of the table's latest date, every filter off for that date."""
    latest = df.select(F.max(date).alias("_m")).scalar()
    condition = F.col(date).between(F.trunc(latest, "month"), F.last_day(latest))
    counted = distinct_counts(df, ctx, key, **{name: condition})
    return counted.withColumn(name, blank(F.col(name)))


def keys_with_single_value(df: DataFrame, ctx: FilterContext, key: str, column: str, value: str, name: str) -> DataFrame:
    """Keys whose rows hold exactly one value (blank is a value too), equal to ``value``."""
    per_key = (
        ctx.apply(df)
        .groupBy(*ctx.by, F.col(key).alias("_key"))
        .agg(F.bool_and(F.coalesce(F.col(column) == value, F.lit(False))).alias("_only"))
    )
    return per_key.groupBy(*ctx.by).agg(blank(F.count_if("_only")).alias(name))


def distinct_if_single(df: DataFrame, ctx: FilterContext, selector: str, counted: str, name: str) -> DataFrame:
    """Distinct values of a column when the group has exactly one selector value, else blank."""
    per_value = (
        ctx.apply(df)
        .groupBy(*ctx.by, F.col(counted).alias("_v"))
        .agg(F.min(selector).alias("_lo"), F.max(selector).alias("_hi"), F.bool_or(F.col(selector).isNull()).alias("_gap"))
    )
    single = (F.min("_lo") == F.max("_hi")) & ~F.bool_or("_gap")
    return per_value.groupBy(*ctx.by).agg(F.when(single, F.count(F.lit(1))).alias(name))


def answer_shares(df: DataFrame, ctx: FilterContext, column: str, **values) -> DataFrame:
    """Share of each answer among the filled answers."""
    c = F.col(column)
    return aggregate(df, ctx, **{n: divide(count_where(c == v), F.count(c)) for n, v in values.items()})


def sum_for_selected(
    df: DataFrame,
    value: str,
    name_column: str,
    source: DataFrame,
    source_column: str,
    name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per group of another table: the sum over the one name the group holds, or over everything when it holds several.

    Names are summed first and looked up by each group's name, so neither table is repeated.
    """
    single = (F.min(source_column) == F.max(source_column)) & ~F.bool_or(F.col(source_column).isNull())
    groups = source.groupBy(*by).agg(F.when(single, F.min(source_column)).alias("_s"))
    sums = df.groupBy(F.col(name_column).alias("_s")).agg(F.sum(value).alias("_sum"))
    total = df.agg(F.sum(value).alias("_sum")).scalar()
    found = groups.join(sums, "_s", "left")
    return found.select(*by, F.when(F.col("_s").isNull(), total).otherwise(F.col("_sum")).alias(name))


def pick_by_slicer(
    df: DataFrame, ctx: FilterContext, rows: Mapping[str, Sequence[str]], columns: Sequence[str], label: str = "fila"
) -> DataFrame:
    """Measures laid out under slicer labels: one row per label, one column per cut.

    ``rows`` maps a label to the measure columns that fill ``columns``. Choosing labels is a
    filter on the result.
    """
    lines = F.array(
        *[
            F.struct(F.lit(text).alias(label), *[F.col(m).alias(c) for m, c in zip(measures, columns)])
            for text, measures in rows.items()
        ]
    )
    return df.select(*ctx.by, F.inline(lines))


def relative_change(df: DataFrame, before: str, after: str, name: str) -> DataFrame:
    return df.withColumn(name, change(F.col(before), F.col(after)))
