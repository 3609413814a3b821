"""Numeric coercion, safe division and number labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Text to double; text that is no number becomes null instead of failing the job."""
    return F.trim(c.cast("string")).try_cast("double")


def percent_to_double(c: Column) -> Column:
    """``"85.5%"`` to ``85.5``."""
    return to_number(F.translate(c.cast("string"), "%", ""))


def divide(a: Column, b: Column, alternate: float | None = None) -> Column:
    """a / b, or ``alternate`` (default null) when b is zero or null; a null gives null."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    if alternate is None:
        return ratio
    return F.when(b.isNull() | (b == 0), F.lit(float(alternate))).otherwise(ratio)


def change(before: Column, after: Column) -> Column:
    """Relative change (after - before) / before; blanks count as zero in the difference."""
    zero = F.lit(0)
    return divide(F.coalesce(after, zero) - F.coalesce(before, zero), before)


def percent_label(ratio: Column) -> Column:
    """0.125 to ``12.5%``; null gives an empty text, as a blank does in a concatenation."""
    shown = F.round(ratio.cast("double") * 100, 1)
    return F.when(ratio.isNull(), F.lit("")).otherwise(F.format_string("%.1f%%", shown))


def count_label(n: Column) -> Column:
    """1234 to ``1,234``; null gives an empty text."""
    return F.coalesce(F.format_number(n, 0), F.lit(""))


def count_percent(n: Column, ratio: Column, thousands: bool = False) -> Column:
    """``n (p%)``."""
    shown = count_label(n) if thousands else F.coalesce(n.cast("string"), F.lit(""))
    return F.concat(shown, F.lit(" ("), percent_label(ratio), F.lit(")"))


def percent_count(ratio: Column, n: Column, noun: str) -> Column:
    """``p%  (n noun)``."""
    return F.concat(percent_label(ratio), F.lit("  ("), count_label(n), F.lit(f" {noun})"))


def blank_to(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))
