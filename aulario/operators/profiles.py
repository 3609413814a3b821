"""Profiles that merge: a small stored row per file and column, united into a codebook without reading the files again.

A stored row holds exact counts and ranges, a HyperLogLog sketch of the values and, for numbers, a KLL sketch of
their quantiles. Sketches have a fixed size and unite, so a new file costs one pass over that file alone.
Distinct counts and quantiles are estimates; everything else is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Relative error of distinct counts about 1.04 / sqrt(2 ** PRECISION): 1.6 %; rank error of quantiles about 1.3 %.
PRECISION = 12
QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def file_profile(df: DataFrame, source: str) -> DataFrame:
    """One row per column of ``df``, and one without a variable that holds the number of rows, under ``source``.

    One aggregate over the table: no value is shuffled, whatever the number of columns.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    kinds = dict(df.dtypes)
    nothing, no_sketch = F.lit(None).cast("double"), F.lit(None).cast("binary")
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        value = F.col(f"`{c}`")
        wanted += [F.count_if(value.isNull()).alias(f"n{i}"), F.hll_sketch_agg(value.cast("string"), PRECISION).alias(f"v{i}")]
        if c in numeric:
            number = value.cast("double")
            wanted += [F.min(number).alias(f"a{i}"), F.max(number).alias(f"z{i}"), F.kll_sketch_agg_double(number).alias(f"q{i}")]

    def line(variable, kind, nulls, low, high, values, numbers):
        named = {"variable": variable, "type": kind, "nulls": nulls, "minimum": low, "maximum": high, "values": values, "numbers": numbers}
        return F.struct(*[v.alias(n) for n, v in named.items()])

    lines = [line(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(0).cast("long"), nothing, nothing, no_sketch, no_sketch)]
    for i, c in enumerate(df.columns):
        range_ = [F.col(f"{x}{i}") if c in numeric else e for x, e in (("a", nothing), ("z", nothing), ("q", no_sketch))]
        lines.append(line(F.lit(c), F.lit(kinds[c]), F.col(f"n{i}"), range_[0], range_[1], F.col(f"v{i}"), range_[2]))
    return df.agg(*wanted).select(F.lit(source).alias("source"), "rows", F.inline(F.array(*lines)))


def merged_codebook(profiles: Sequence[DataFrame] | DataFrame, digits: int | None = None) -> DataFrame:
    """Codebook of all profiled files together, one row per column name.

    A file profiled again under its source counts once (its rows must be equal); a column that a file lacks counts as
    null for that file's rows, as in a union of years; differing types are listed.
    """
    stored = profiles if isinstance(profiles, DataFrame) else _stacked(profiles)
    # One row per file and column: sketches of one file are equal, whichever row they come from.
    once = stored.groupBy("source", "variable").agg(
        F.first("rows").alias("rows"),
        *[F.first(c).alias(c) for c in ("type", "nulls", "minimum", "maximum", "values", "numbers")],
    )
    total = once.filter("variable is null").agg(F.sum("rows")).scalar()
    merged = once.filter("variable is not null").groupBy("variable").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("type"),
        F.sum("nulls").alias("_nulls"),
        F.sum("rows").alias("_rows"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.hll_union_agg("values").alias("_values"),
        F.kll_merge_agg_double("numbers").alias("_numbers"),
    )
    nulls = F.col("_nulls") + total - F.col("_rows")
    share = F.try_divide(nulls * 100.0, total)
    # Quantiles exist where the column held a number in any file.
    numbers = F.when(F.col("minimum").isNotNull(), F.col("_numbers"))
    return merged.select(
        "variable",
        "type",
        nulls.alias("nulls"),
        (F.round(share, digits) if digits is not None else share).alias("null_percent"),
        F.hll_sketch_estimate("_values").alias("distinct_values"),
        "minimum",
        "maximum",
        *[F.kll_sketch_get_quantile_double(numbers, F.lit(q)).alias(n) for n, q in QUANTILES.items()],
    )


def _stacked(profiles: Sequence[DataFrame]) -> DataFrame:
    out = profiles[0]
    for profile in profiles[1:]:
        out = out.unionByName(profile)
    return out
