"""Code tables as literal maps: no join, no shuffle, size fixed by the source text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lookup(c: Column, table: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[c]


def map_or_keep(c: Column, table: Mapping[str, str]) -> Column:
    """Mapped value, or the original when the code is unknown; null stays null."""
    return F.coalesce(_lookup(c, table), c)


def map_or_null(c: Column, table: Mapping[str, object]) -> Column:
    """Mapped value, or null when the code is unknown."""
    return _lookup(c, table)
