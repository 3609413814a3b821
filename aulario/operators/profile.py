"""Data-quality profiles: codebook, value counts, duplicate and null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, null counted as a value; ties by value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.col(column).asc_nulls_first())
        .limit(k)
    )


def duplicate_and_null_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier key combination, nulls per column, and rows in all.

    One row per measure. Counting per key first keeps a frequent key to one row per task;
    null counts ride along as sums, so the table is read once.
    """
    per_key = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_n{i}") for i in range(len(columns))],
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )
    names = ["duplicates", *[f"_n{i}" for i in range(len(columns))], "rows"]
    labels = ["duplicates", *[f"nulls {c}" for c in columns], "rows"]
    pairs = F.array(*[F.struct(F.lit(t).alias("metric"), F.col(n).alias("n")) for t, n in zip(labels, names)])
    return totals.select(F.inline(pairs))


def codebook(
    df: DataFrame,
    key: str | None = None,
    digits: int | None = None,
    min_max: bool = True,
    duplicates: bool = True,
    sample: str | None = "adaptive",
    approximate: bool = False,
) -> DataFrame:
    """One row per column: type, nulls, distinct values, range, duplicates, sample values.

    ``key`` names the column whose duplicates are counted; ``digits`` rounds the null share.
    ``sample`` is ``adaptive`` (all values up to 50, otherwise the count and five examples),
    ``five``, or None. Samples are in value order. ``approximate`` counts distinct values
    with a sketch and then leaves out duplicates and samples, which need every value.

    The exact form turns the table into (column, value) pairs and counts those, so the whole
    profile is one pass and one shuffle, pre-aggregated, however many columns there are.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    order = {f.name: i for i, f in enumerate(df.schema)}
    spark_types = dict(df.dtypes)

    if approximate:
        return _approximate_codebook(df, numeric, digits, min_max)

    pairs = F.array(
        *[
            F.struct(
                F.lit(order[c]).alias("position"),
                F.col(f"`{c}`").cast("string").alias("value"),
                (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("number"),
            )
            for c in df.columns
        ]
    )
    counted = df.select(F.inline(pairs)).groupBy("position", "value", "number").agg(
        F.count(F.lit(1)).alias("n")
    )
    present = F.col("value").isNotNull()
    summary = counted.groupBy("position").agg(
        F.sum(F.when(~present, F.col("n")).otherwise(0)).alias("nulls"),
        F.sum("n").alias("_rows"),
        F.count_if(present).alias("distinct_values"),
        F.min("number").alias("minimum"),
        F.max("number").alias("maximum"),
        F.sum(F.when(present, F.col("n") - 1).otherwise(0)).alias("_repeats"),
        F.max(F.col("n") > 1).alias("_any_repeat"),
    )
    if sample:
        # A rank limit is applied on each task before the shuffle: at most 50 values travel. The
        # null value ranks last and is not collected; a filter would keep Spark from reusing
        # the counted pairs, as would leaving out the count.
        by_value = Window.partitionBy("position").orderBy(F.col("value").asc_nulls_last(), "n")
        examples = (
            counted.withColumn("_rank", F.row_number().over(by_value))
            .filter("_rank <= 50")
            .groupBy("position")
            .agg(F.sort_array(F.collect_list("value")).alias("_values"))
        )
        summary = summary.join(examples, "position", "left")

    names = F.create_map(*[F.lit(x) for c, i in order.items() for x in (i, c)])
    kinds = F.create_map(*[F.lit(x) for c, i in order.items() for x in (i, spark_types[c])])
    share = F.try_divide(F.col("nulls") * 100.0, F.col("_rows"))
    out = [
        names[F.col("position")].alias("variable"),
        kinds[F.col("position")].alias("type"),
        F.col("nulls"),
        (F.round(share, digits) if digits is not None else share).alias("null_percent"),
        F.col("distinct_values"),
    ]
    if min_max:
        out += [F.col("minimum"), F.col("maximum")]
    if duplicates:
        is_key = F.col("position") == (order[key] if key in order else -1)
        out.append(
            F.when(
                is_key,
                F.when(
                    F.col("_repeats") > 0,
                    F.concat(F.lit("Sí ("), F.col("_repeats").cast("string"), F.lit(" duplicados)")),
                ).otherwise("No (PK válida)"),
            )
            .when(F.col("_any_repeat"), "Sí")
            .otherwise("No")
            .alias("duplicates")
        )
    if sample:
        values = F.coalesce(F.col("_values"), F.array().cast("array<string>"))
        first_five = F.array_join(F.slice(values, 1, 5), ", ")
        if sample == "five":
            shown = first_five
        else:
            shown = F.when(
                F.col("distinct_values") > 50,
                F.concat(F.lit("("), F.col("distinct_values").cast("string"), F.lit(" valores) Ej: "), first_five),
            ).otherwise(F.array_join(values, ", "))
        out.append(shown.alias("sample"))
    return summary.select(*out)


def _approximate_codebook(df: DataFrame, numeric: set[str], digits: int | None, min_max: bool) -> DataFrame:
    """Codebook from one aggregate row: nulls exact, distinct counts by sketch, no shuffle of values."""
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        column = F.col(f"`{c}`")
        aggregates += [
            F.count_if(column.isNull()).alias(f"n{i}"),
            F.approx_count_distinct(column).alias(f"d{i}"),
            (F.min(column).cast("double") if c in numeric else F.max(F.lit(None).cast("double"))).alias(f"a{i}"),
            (F.max(column).cast("double") if c in numeric else F.max(F.lit(None).cast("double"))).alias(f"z{i}"),
        ]
    kinds = dict(df.dtypes)
    rows = []
    for i, c in enumerate(df.columns):
        share = F.try_divide(F.col(f"n{i}") * 100.0, F.col("_rows"))
        fields = [
            F.lit(c).alias("variable"),
            F.lit(kinds[c]).alias("type"),
            F.col(f"n{i}").alias("nulls"),
            (F.round(share, digits) if digits is not None else share).alias("null_percent"),
            F.col(f"d{i}").alias("distinct_values"),
        ]
        if min_max:
            fields += [F.col(f"a{i}").alias("minimum"), F.col(f"z{i}").alias("maximum")]
        rows.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))
