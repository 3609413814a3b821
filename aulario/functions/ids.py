"""Identity-document cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(c: Column) -> Column:
    """Keep the digits only; nothing left is null.

    Note that ``79952505.0`` becomes ``799525050``: use :func:`document_id` for columns that
    passed through a floating-point type.
    """
    return F.nullif(F.regexp_replace(c, r"\D", ""), F.lit(""))


def document_id(c: Column, null_values: Sequence[str] = ()) -> Column:
    """Drop a trailing ``.0`` left by a numeric column, then keep digits.

    The trailing zero fraction is removed only when digits stand before it. ``null_values``
    lists cleaned values that mean "no id" (for instance ``0``).
    """
    cleaned = digits(F.regexp_replace(F.trim(c), r"^(\d+)\.0+$", "$1"))
    # ``nullif`` computes its argument once, which a CASE over the cleaned text would not.
    for value in null_values:
        cleaned = F.nullif(cleaned, F.lit(value))
    return cleaned
