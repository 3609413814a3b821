"""Set operations: union of years and sheets, split and re-union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from one is null there.

    Column order is that of first appearance.
    """
    if not frames:
        raise ValueError("nothing to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_years(
    by_year: Mapping[str, DataFrame], tag: str = "ANIO_FUENTE", keep_year_tag: bool = True
) -> DataFrame:
    """Stack one table per year, each row tagged with its source year."""
    frames = [
        df.withColumn(tag, F.lit(year)) if keep_year_tag else df for year, df in by_year.items()
    ]
    return union_aligned(frames)
