"""Distinct counts that can be added up: keys as bits, stored per combination of dimensions.

A distinct count cannot be summed over groups, since a key may be in several. A set of bits can be united. Keys are
numbered once in a dictionary; a store holds, per combination of dimensions (site, day, status, ...) and
block of 32,768 numbers, which keys occur. Any grouping, cut-off date, filter on the dimensions or total is then a union of
stored bits and a count of ones: the detail rows are not read again, and a new load only adds its own rows.

Numbers follow the order of ``near`` columns, so that the keys of one site lie in few blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.sources.stages import stage

# Numbers of one partition of the dictionary's keys start at a multiple of this.
_PARTITION = 1 << 33


def number_keys(df: DataFrame, key: str, near: Sequence[str] = (), known: DataFrame | None = None) -> DataFrame:
    """Dictionary of the filled keys of ``df``: ``key, id`` with ids from 1; those of ``known`` keep theirs.

    Ids are unique, not gapless. The dictionary is written, so its numbers are fixed.
    """
    fresh = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(*[F.min(c).alias(f"_near_{i}") for i, c in enumerate(near)] or [F.lit(0).alias("_near_0")])
    first = 0
    if known is not None:
        fresh = fresh.join(known.select("key"), "key", "left_anti")
        top = known.agg(F.max("id")).first()[0]
        first = 0 if top is None else (top // _PARTITION + 1) * _PARTITION
    order = [*[c for c in fresh.columns if c != "key"], "key"]
    numbered = fresh.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "key", (F.monotonically_increasing_id() + F.lit(first + 1)).alias("id")
    )
    return stage(numbered if known is None else known.unionByName(numbered), "key-numbers")


def key_bitmaps(df: DataFrame, key: str, dims: Mapping[str, Column], numbers: DataFrame) -> DataFrame:
    """Store of ``df``: the dimensions, ``_block`` and ``_bits``; written.

    A null key is a value of its own, as in the report. Rows are reduced to distinct (dimensions, key) before
    keys are looked up, so a frequent key costs a row per combination.
    """
    pairs = df.select(*[c.alias(n) for n, c in dims.items()], F.col(key).alias("key")).distinct()
    filled = pairs.filter("key is not null").join(numbers, "key").select(*dims, "id")
    missing = pairs.filter("key is null").select(*dims, F.lit(0).cast("long").alias("id"))
    rows = filled.unionByName(missing)
    place, block = F.bitmap_bit_position("id"), F.bitmap_bucket_number("id")
    return stage(rows.groupBy(*dims, block.alias("_block")).agg(F.bitmap_construct_agg(place).alias("_bits")), "key-bitmaps")


def united(stores: Sequence[DataFrame], dims: Sequence[str]) -> DataFrame:
    """One store for several loads; a load that is added twice changes nothing."""
    every = stores[0]
    for store in stores[1:]:
        every = every.unionByName(store)
    return every.groupBy(*dims, "_block").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def count_keys(store: DataFrame, by: Sequence[str] = (), **conditions: Column) -> DataFrame:
    """Distinct keys per group under each condition on the dimensions (0 where nothing matches)."""
    bits = [F.bitmap_or_agg(F.when(c, F.col("_bits"))).alias(n) for n, c in conditions.items()]
    blocks = store.groupBy(*by, "_block").agg(*bits)
    ones = [F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).cast("long").alias(n) for n in conditions]
    return blocks.groupBy(*by).agg(*ones)
