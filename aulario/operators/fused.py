"""One pass over a table for many measures: what they need per group and key is gathered once.

Most measures are finished from a small number of values per (group, key): row counts, first and last dates,
largest amounts, flags. ``gather`` takes the ingredients of any number of measures, with their own filters, in a single
scan and shuffle and writes the result; each measure is then finished from rows per key instead of rows
of the table. Where measures count different keys (children, days), a row stands once under each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.sources.stages import stage


def gather_plan(df: DataFrame, by: Sequence[str], keys: Sequence[str], ingredients: Mapping[str, Column]) -> DataFrame:
    """Per group and key: ``_kind`` (the key column), ``_key`` (as text) and the ingredients."""
    taken = sorted(ingredients)
    if len(keys) == 1:
        rows = df.withColumns({"_kind": F.lit(keys[0]), "_key": F.col(keys[0]).cast("string")})
    else:
        sides = F.array(*[F.struct(F.lit(k).alias("_kind"), F.col(k).cast("string").alias("_key")) for k in keys])
        rows = df.select("*", F.inline(sides))
    return rows.groupBy(*by, "_kind", "_key").agg(*[ingredients[n].alias(n) for n in taken])


def gather(df: DataFrame, by: Sequence[str], keys: Sequence[str], ingredients: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Rows per group and key, by key column, from one written table."""
    found = stage(gather_plan(df, by, keys, ingredients), "per-key")
    return {k: found.filter(F.col("_kind") == k).drop("_kind") for k in keys}


def finish(per_key: DataFrame, by: Sequence[str], present: str, **columns: Column) -> DataFrame:
    """Aggregates per group, for the groups with a row in scope (``present`` counts them)."""
    out = per_key.groupBy(*by).agg(F.sum(present).alias("_present"), *[c.alias(n) for n, c in columns.items()])
    return (out.filter("_present > 0") if by else out).drop("_present")
