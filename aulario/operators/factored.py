"""Matches kept factored: the sides as they are, and per key how many rows each has.

Where ids repeat, or are null and match one another, a join of n sides has the product of their rows per key. Most uses need
that product only in a sum: a count, a total or a mean of one side's column. Here the product is never built for
them: a group holds the sides' counts, and a row of a side stands for as many joined rows as the other sides' counts
multiply to. ``unrolled`` builds the joined rows where they are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.operators.joins import join_lookup, join_null_safe
from aulario.sources.stages import stage

# Whole numbers of joined rows may pass 64 bits.
_NUMBER = "decimal(38,0)"
_KEY = "_match"


def _matched(keys: Sequence[str]) -> Column:
    """The key as one column; null parts are equal to each other, as Spark compares structs."""
    return F.struct(*[F.col(f"`{k}`") for k in keys])


@dataclass(frozen=True)
class Factored:
    """A match of several sides on ``keys``; ``groups`` has the key and the count ``n0``, ``n1``, ... of each side.

    The first side drives; each other one has a ``how``, ``inner`` or ``left``.
    """

    keys: tuple[str, ...]
    sides: tuple[DataFrame, ...]
    hows: tuple[str, ...]
    groups: DataFrame

    def _factor(self, i: int) -> Column:
        """Rows that side ``i`` gives each group; a side joined by ``left`` gives one of nulls where it has none."""
        n = F.coalesce(F.col(f"n{i}"), F.lit(0)).cast(_NUMBER)
        return F.greatest(n, F.lit(1).cast(_NUMBER)) if i and self.hows[i - 1] == "left" else n

    def _product(self, without: int | None = None) -> Column:
        out = F.lit(1).cast(_NUMBER)
        for i in range(len(self.sides)):
            if i != without:
                out = (out * self._factor(i)).cast(_NUMBER)
        return out

    def links(self) -> DataFrame:
        """Per key the number of joined rows, ``links``; keys without any are left out."""
        counted = self.groups.select(*[F.col(f"{_KEY}.`{k}`").alias(k) for k in self.keys], self._product().alias("links"))
        return counted.filter("links > 0")

    def n_rows(self) -> DataFrame:
        """One row: how many rows the join has, ``links``."""
        return self.groups.agg(F.coalesce(F.sum(self._product()), F.lit(0)).cast(_NUMBER).alias("links"))

    def weighted(self, side: int = 0) -> DataFrame:
        """Rows of a side and ``links``, the joined rows each of them is part of; rows that are in none are left out.

        A sum over the join of a column of this side is the sum of column times ``links``. The rows of nulls that a
        side joined by ``left`` gives are not among its rows.
        """
        weights = stage(self.groups.select(_KEY, self._product(side).alias("links")).filter("links > 0"), "links")
        return join_lookup(self.sides[side].withColumn(_KEY, _matched(self.keys)), weights, [_KEY]).drop(_KEY)

    def unrolled(self) -> DataFrame:
        """The joined rows themselves."""
        out = self.sides[0]
        for side, how in zip(self.sides[1:], self.hows):
            out = join_null_safe(out, side, self.keys, how)
        return out


def factor(first: DataFrame, others: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> Factored:
    """Match sides on keys, null keys equal; columns other than the keys must have names of their own.

    Each side is counted per key where its rows lie, so a key of any frequency costs a row per task. A side may be empty.
    """
    sides, hows = (first, *[df for df, _ in others]), tuple(how for _, how in others)
    if wrong := set(hows) - {"inner", "left"}:
        raise ValueError(f"how must be inner or left, not {sorted(wrong)[0]}")
    plain = [c for side in sides for c in side.columns if c not in keys]
    if twice := {c for c in plain if plain.count(c) > 1}:
        raise ValueError(f"columns in more than one side: {', '.join(sorted(twice))}")
    counts = None
    for i, side in enumerate(sides):
        numbers = [F.lit(1 if i == j else 0).cast("long").alias(f"_{j}") for j in range(len(sides))]
        rows = side.select(_matched(keys).alias(_KEY), *numbers)
        counts = rows if counts is None else counts.unionByName(rows)
    groups = counts.groupBy(_KEY).agg(*[F.sum(f"_{i}").alias(f"n{i}") for i in range(len(sides))])
    return Factored(tuple(keys), sides, hows, stage(groups, "match-groups"))
