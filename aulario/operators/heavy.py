"""Joins that treat frequent keys apart: found by a sketch, joined by broadcast, the rest by shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most keys treated as frequent, and items the sketch tracks for each (its counts are off by at most
# 3.5 / items of the rows). A lookup's rows for these keys are what is broadcast.
HEAVY_KEYS = 1_000
_TRACKED = 10


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of the key columns; null where one of them is, as such a row matches nothing."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(f"`{key}`").isNotNull()
    return F.when(complete, F.xxhash64(*[F.col(f"`{key}`") for key in keys]))


def heavy_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> list[int]:
    """Hashes of the keys that hold more than half of an even share of the rows among ``parts`` tasks.

    One pass: each task keeps a sketch of fixed size, and at most ``HEAVY_KEYS`` hashes reach the driver. ``parts``
    is the number of shuffle partitions unless given.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * parts, HEAVY_KEYS)
    hashes = df.select(key_hash(keys).alias("h")).filter("h IS NOT NULL")
    found = hashes.agg(F.expr(f"approx_top_k(h, {most}, {most * _TRACKED})").alias("top"), F.count("h").alias("rows")).first()
    return sorted(item["item"] for item in found["top"] or [] if 2 * parts * item["count"] > found["rows"])


def split_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", parts: int | None = None) -> DataFrame:
    """Join a large table to a lookup with at most one row per key (``inner`` or ``left``), whatever the keys' frequencies.

    Rows of frequent keys meet the lookup's rows for them, at most ``HEAVY_KEYS``, by broadcast and stay where they are;
    the rest is shuffled, and no task of it holds more than its share and half another by one key. Rows with a null key
    are not shuffled: they match nothing. Reads ``big`` once more for the sketch; write an expensive one first.
    A lookup with repeated keys gives the same rows as a plain join, but its repeats are broadcast too, so do not pass one.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    keys = list(keys)
    hot = heavy_keys(big, keys, parts)
    h = key_hash(keys)
    some = h.isin(hot) if hot else F.lit(False)
    # What a null hash gives is told apart by itself, so each row is in one part.
    whole = big.filter(h.isNotNull() & ~some).join(small.filter(h.isNotNull() & ~some) if hot else small, keys, how)
    if hot:
        whole = whole.unionByName(big.filter(h.isNotNull() & some).join(F.broadcast(small.filter(h.isNotNull() & some)), keys, how))
    if how == "left":
        fields = [f for f in small.schema.fields if f.name not in keys]
        alone = big.filter(h.isNull()).select(
            *[F.col(f"`{k}`") for k in keys],
            *[F.col(f"`{c}`") for c in big.columns if c not in keys],
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
        )
        whole = whole.unionByName(alone)
    return whole
