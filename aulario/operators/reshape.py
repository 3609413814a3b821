"""Wide to long and back: unpivots, expansions, backward fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.dates import date_like
from aulario.operators.joins import join_null_safe

TOTALS = ("ASISTENCIAS ESPERADAS", "ASISTENCIAS REALES", "% DE PARTICIPACIÓN")


def unpivot_dates(df: DataFrame, ids: Sequence[str], date_columns: Sequence[str]) -> DataFrame:
    """One row per id row and date column, empty marks included.

    Up to three columns that follow the last date column are kept and renamed by position to
    the attendance totals. Column names are read with the shared date parser.
    """
    columns = df.columns
    last = max(columns.index(c) for c in date_columns)
    tail = columns[last + 1 : last + 1 + len(TOTALS)]
    renamed = df.withColumnsRenamed(dict(zip(tail, TOTALS)))
    keep = [*ids, *TOTALS[: len(tail)]]
    long = renamed.select(*[F.col(f"`{c}`") for c in keep], *[
        F.col(f"`{c}`").cast("string").alias(c) for c in date_columns
    ]).unpivot([F.col(f"`{c}`") for c in keep], [F.col(f"`{c}`") for c in date_columns], "fecha", "asistencia")
    return long.withColumn("fecha", date_like(F.col("fecha")))


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Plain unpivot, null values included; the value columns must share a type."""
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], name, value)


def unpivot_labelled(
    df: DataFrame, ids: Sequence[str], labels: Mapping[str, str], name: str, value: str
) -> DataFrame:
    """Unpivot in which each column gives a label (level columns to LB / LS, questions to codes)."""
    rows = F.array(
        *[F.struct(F.lit(label).alias(name), F.col(f"`{c}`").alias(value)) for c, label in labels.items()]
    )
    return df.select(*[F.col(f"`{c}`") for c in ids], F.inline(rows))


def unpivot_pairs(
    df: DataFrame, ids: Sequence[str], pairs: Mapping[str, tuple[str, str]], code: str, first: str, second: str
) -> DataFrame:
    """Unpivot two parallel column families row by row: one output row per code.

    Same rows as unpivoting each family and joining on (id, code) when ids are unique, without
    the join. A repeated or missing id pairs only with itself here.
    """
    rows = F.array(
        *[
            F.struct(F.lit(k).alias(code), F.col(f"`{a}`").alias(first), F.col(f"`{b}`").alias(second))
            for k, (a, b) in pairs.items()
        ]
    )
    return df.select(*[F.col(f"`{c}`") for c in ids], F.inline(rows))


def unpivot_join(
    df: DataFrame,
    keys: Sequence[str],
    first_columns: Mapping[str, str],
    second_columns: Mapping[str, str],
    code: str,
    first: str,
    second: str,
) -> DataFrame:
    """Unpivot two families separately and inner-join them on (keys, code), null ids matching.

    Repeated ids fan out, every first value meeting every second value of the same id and
    code; use :func:`unpivot_pairs` when rows should pair only with themselves.
    """
    a = unpivot_labelled(df, keys, first_columns, code, first)
    b = unpivot_labelled(df, keys, second_columns, code, second)
    return join_null_safe(a, b, [*keys, code], "inner")


def expand_values(df: DataFrame, column: str, table: Mapping[str, Sequence[str]], into: str) -> DataFrame:
    """One row per value listed for a code; a code without a list gives itself."""
    lists = F.create_map(
        *[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(e) for e in v]))]
    )
    values = F.coalesce(lists[F.col(column)], F.array(F.col(column)))
    return df.withColumn(into, F.explode(values))


def replicate_value(df: DataFrame, column: str, value: str, copies: Sequence[str]) -> DataFrame:
    """Rows holding ``value`` are repeated once per copy under the copy's name; others stay."""
    names = F.when(F.col(column) == value, F.array(*[F.lit(c) for c in copies])).otherwise(
        F.array(F.col(column))
    )
    return df.withColumn(column, F.explode(names))


def backfill(
    df: DataFrame, partition: Sequence[str], order: str, column: str, into: str, block: int = 100_000
) -> DataFrame:
    """Fill each null with the next filled value below it in the same partition.

    ``order`` is an integer column, unique within the partition. Rows are cut into blocks of
    ``block`` order values. Each block first reports its first filled value, the (few) blocks
    are filled backward from one another, and then rows only look inside their own block. No
    task ever holds more than one block, however large a partition is.
    """
    partition = list(partition)
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    blocks = blocked.groupBy(*partition, "_block").agg(
        F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.col(order))).alias("_first")
    )
    following = Window.partitionBy(*partition).orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    below = blocks.withColumn("_below", F.first("_first", ignorenulls=True).over(following)).drop("_first")
    inside = Window.partitionBy(*partition, "_block").orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return (
        join_null_safe(blocked, below, [*partition, "_block"], "left", spread=False)
        .withColumn(into, F.coalesce(F.first(F.col(column), ignorenulls=True).over(inside), F.col("_below")))
        .drop("_block", "_below")
    )


def chosen_question(df: DataFrame, ids: Sequence[str], questions: Mapping[str, str], chosen: Column | str) -> DataFrame:
    """Answers to the chosen survey question, one row per respondent row."""
    wanted = F.lit(chosen) if isinstance(chosen, str) else chosen
    return unpivot_labelled(df, ids, questions, "pregunta", "respuesta").filter(F.col("pregunta") == wanted)
