"""Dates: lenient parsing with a declared format list, serials, month words, ages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each format is tried only on text of its shape, so bad cells cost a regular-expression
# test, not a parse exception. ISO text is read as ISO; everything else is day first.
FORMATS: tuple[tuple[str, str], ...] = (
    (r"^\d{4}-\d{2}-\d{2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$", "yyyy-MM-dd[ H:mm[:ss]]"),
    (r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}( \d{1,2}:\d{2}(:\d{2})?)?$", "d/M/yyyy[ H:mm[:ss]]"),
    (r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{2}$", "d/M/yy"),
)

# Spreadsheet serials accepted as dates, counted from the epoch below.
SERIAL_EPOCH = "1899-12-30"
SERIAL_MIN, SERIAL_MAX = 20000, 60000


def parse_timestamp(c: Column, formats: tuple[tuple[str, str], ...] = FORMATS) -> Column:
    """Lenient day-first parse of text to a zone-free timestamp; unreadable text is null."""
    text = F.trim(c)
    out = None
    for shape, pattern in formats:
        if pattern.startswith("d"):
            body = F.regexp_replace(text, r"^(\d{1,2})[/.-](\d{1,2})[/.-]", "$1/$2/")
        else:
            body = F.regexp_replace(F.translate(text, "T", " "), r"\.\d+$", "")
        parsed = F.try_to_timestamp(body, F.lit(pattern)).cast("timestamp_ntz")
        out = F.when(text.rlike(shape), parsed) if out is None else out.when(text.rlike(shape), parsed)
    return out


def parse_date(c: Column, formats: tuple[tuple[str, str], ...] = FORMATS) -> Column:
    return parse_timestamp(c, formats).cast("date")


def from_serial(c: Column) -> Column:
    """Spreadsheet serial (text or number) between the accepted bounds to a timestamp."""
    number = F.trim(c.cast("string")).try_cast("double")
    inside = (number > SERIAL_MIN) & (number < SERIAL_MAX)
    micros = F.round((number - 25569) * 86_400_000_000).cast("bigint")
    # Seconds are added through an interval so that the result carries no time zone.
    stamp = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(micros / 1_000_000).cast("decimal(18,6)")
    )
    return F.when(inside, stamp)


def date_like(c: Column) -> Column:
    """Header cell to a date: ISO or day-first text, or a serial; other text is null.

    Month words (``mar``, ``abr`` …) name totals columns, not dates, and match no format.
    """
    return F.coalesce(parse_timestamp(c), from_serial(c)).cast("date")


def month_word_date(
    c: Column, year: int, months: Mapping[str, int], fixed: Mapping[str, str]
) -> Column:
    """Date from a normal date text, a month word (first day of it) or a fixed wording.

    ``fixed`` maps wordings to ISO dates; ``{year}`` in them is the programme year.
    """
    text = F.lower(F.trim(c))
    words = {word: f"{year:04d}-{month:02d}-01" for word, month in months.items()}
    words |= {word: value.format(year=year) for word, value in fixed.items()}
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.coalesce(parse_date(c), table[text].cast("date"))


def day_first_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def month_name(c: Column) -> Column:
    """English month name."""
    return F.date_format(c, "MMMM")


def age_years(birth: Column, as_of: Column) -> Column:
    """Whole years as days / 365.25, truncated toward zero."""
    return (F.datediff(as_of, birth) / F.lit(365.25)).cast("int")


def years_in(c: Column) -> Column:
    """Array of the four-digit numbers in a text (non-overlapping, left to right)."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d{4})"), F.lit(1)), lambda y: y.cast("int"))


def largest_year(c: Column) -> Column:
    """Largest four-digit number in a text, null when there is none."""
    return F.array_max(years_in(c))


def month_start(c: Column) -> Column:
    return F.trunc(c, "month").cast("date")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def same_month(a: Column, b: Column) -> Column:
    return F.trunc(a, "month") == F.trunc(b, "month")
