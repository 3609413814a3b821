"""Cell grids: find headers and dates, resolve headings, turn sheets into records.

Input is ``cells(file, sheet, row, col, value)``, rows and columns counted from 0, empty
cells absent. A sheet is described by one *layout* row (heading positions, date positions);
its data become one *record* row per spreadsheet row, holding ``col -> value``. Both are
bounded by the width of a sheet, so a huge sheet means many records, never a big one, and
records are shuffled by (file, sheet, row), which no single sheet dominates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.dates import date_like
from aulario.functions.text import norm_key, strip
from aulario.operators.joins import fits_broadcast, join_lookup
from aulario.sources.stages import stage

SHEET = ["file", "sheet"]


def filled(cells: DataFrame) -> DataFrame:
    """Cells with text in them; all-empty rows and columns vanish with their cells."""
    return cells.filter(F.col("value").isNotNull() & (F.trim("value") != ""))


# --- header rows -------------------------------------------------------------------------


def header_row_with_titles(
    cells: DataFrame, required: Sequence[str], any_of: Sequence[str], max_rows: int = 20
) -> DataFrame:
    """First of the top rows holding every required title and one of the alternatives.

    Returns (file, sheet, header_row); sheets without such a row are absent.
    """
    title = F.upper(strip(F.col("value")))
    found = (
        cells.filter(F.col("row") < max_rows)
        .filter(title.isin(*required, *any_of))
        .groupBy(*SHEET, "row")
        .agg(
            *[F.bool_or(title == t).alias(f"_t{i}") for i, t in enumerate(required)],
            F.bool_or(title.isin(*any_of)).alias("_any"),
        )
    )
    complete = F.col("_any")
    for i in range(len(required)):
        complete = complete & F.col(f"_t{i}")
    return found.filter(complete).groupBy(*SHEET).agg(F.min("row").alias("header_row"))


def header_row_containing(cells: DataFrame, text: str) -> DataFrame:
    """First row with a cell that contains ``text`` (any case)."""
    return (
        cells.filter(F.upper("value").contains(text.upper()))
        .groupBy(*SHEET)
        .agg(F.min("row").alias("header_row"))
    )


def header_row_fixed(cells: DataFrame, row: int) -> DataFrame:
    """A header row at a known position, for the sheets that have cells there."""
    return cells.filter(F.col("row") == row).select(*SHEET).distinct().withColumn("header_row", F.lit(row))


def header_cells(
    cells: DataFrame, header_rows: DataFrame, first_col: int = 0, max_rows: int | None = None
) -> DataFrame:
    """Heading cells of each sheet: (file, sheet, header_row, col, header).

    The header rows, one per sheet, are written first and their size checked, so that cells of other
    rows drop out where they lie and are not shuffled. ``max_rows`` repeats
    the bound of the header search, which then reaches the scan of the cells as well.
    """
    if max_rows is not None:
        cells = cells.filter(F.col("row") < max_rows)
    at = stage(header_rows.select(*SHEET, F.col("header_row").alias("row")), "header-rows")
    return (
        join_lookup(filled(cells).filter(F.col("col") >= first_col), at, [*SHEET, "row"])
        .select(*SHEET, F.col("row").alias("header_row"), "col", F.col("value").alias("header"))
    )


def fixed_header_cells(cells: DataFrame, row: int, first_col: int = 0) -> DataFrame:
    """Heading cells at a fixed row; both filters reach the scan."""
    return (
        filled(cells.filter((F.col("row") == row) & (F.col("col") >= first_col)))
        .select(*SHEET, F.lit(row).alias("header_row"), "col", F.col("value").alias("header"))
    )


def two_row_headers(
    cells: DataFrame, activity_row: int, date_row: int, header_row: int, separator: str = " - "
) -> DataFrame:
    """Headings made of a date row and an activity row: ``2025-03-04 - Visita``."""
    top = filled(cells.filter(F.col("row").isin(activity_row, date_row)))
    pieces = top.groupBy(*SHEET, "col").agg(
        F.max(F.when(F.col("row") == activity_row, F.col("value"))).alias("activity"),
        F.max(F.when(F.col("row") == date_row, F.col("value"))).alias("date_text"),
    )
    date_text = F.date_format(date_like(F.col("date_text")), "yyyy-MM-dd")
    name = F.regexp_replace(F.concat_ws(separator, date_text, F.col("activity")), r"^[ -]+|[ -]+$", "")
    return pieces.filter(name != "").select(
        *SHEET, F.lit(header_row).alias("header_row"), "col", name.alias("header")
    )


# --- headings ----------------------------------------------------------------------------


def with_dates(headers: DataFrame) -> DataFrame:
    """Add the date a heading stands for, null for ordinary headings."""
    return headers.withColumn("date", date_like(F.col("header")))


def within_date_range(headers: DataFrame, extra: int = 3) -> DataFrame:
    """Keep columns up to the last date column plus ``extra``; sheets without dates go.

    ``offset`` numbers the columns after the last date (1, 2, 3), null elsewhere.
    """
    last = F.max(F.when(F.col("date").isNotNull(), F.col("col"))).over(Window.partitionBy(*SHEET))
    return (
        headers.withColumn("_last", last)
        .filter(F.col("col") <= F.col("_last") + extra)
        .withColumn("offset", F.when(F.col("col") > F.col("_last"), F.col("col") - F.col("_last")))
        .drop("_last")
    )


def duplicate_headers(headers: DataFrame, mark: str | None = None) -> DataFrame:
    """Repeated headings of a sheet: keep the first, or number the others.

    ``mark`` stands before the number: ``_v`` gives ``X``, ``X_v1``, ``X_v2``; ``.`` gives
    ``X``, ``X.1``, ``X.2``.
    """
    # Columns found by position are told apart by it, so that none counts as a repetition.
    place = F.when(~is_ordinary(headers), F.col("col"))
    order = Window.partitionBy(*SHEET, "header", place).orderBy("col")
    ranked = headers.withColumn("_n", F.row_number().over(order))
    if mark is None:
        return ranked.filter("_n = 1").drop("_n")
    numbered = F.concat("header", F.lit(mark), (F.col("_n") - 1).cast("string"))
    return ranked.withColumn("header", F.when(F.col("_n") == 1, F.col("header")).otherwise(numbered)).drop("_n")


def role_cell(role: str) -> Column:
    """Value of a data record in the column that plays a role, null without such a column."""
    return F.col("cells")[F.col(f"role_{role}")]


def with_data(headers: DataFrame, cells: DataFrame) -> DataFrame:
    """Headings whose column holds at least one cell below the header row."""
    used = cells.groupBy(*SHEET, "col").agg(F.max(F.when(F.col("value").isNotNull(), F.col("row"))).alias("_deepest"))
    return headers.join(used, [*SHEET, "col"]).filter(F.col("_deepest") > F.col("header_row")).drop("_deepest")


def compact_range(headers: DataFrame, cells: DataFrame, tail: int = 3) -> DataFrame:
    """Drop the columns of a date range that hold nothing, and number what follows the last date anew.

    A sheet whose dates are all unused goes. ``offset`` counts the columns left after the last
    used date; those beyond ``tail`` go as well.
    """
    sheet = Window.partitionBy(*SHEET)
    last = F.max(F.when(F.col("date").isNotNull(), F.col("col"))).over(sheet)
    after = F.col("col") > F.col("_last")
    place = F.row_number().over(Window.partitionBy(*SHEET, after).orderBy("col"))
    return (
        with_data(headers, cells)
        .withColumn("_last", last)
        .filter(F.col("_last").isNotNull())
        .withColumn("offset", F.when(after, place))
        .filter(F.col("offset").isNull() | (F.col("offset") <= tail))
        .drop("_last")
    )


def heading_list(headers: DataFrame, limit: int | None = None) -> list[str]:
    """Distinct headings in order of first appearance; more than ``limit``, if given, is an error.

    They become the columns of a wide table, so the driver holds them in any case.
    """
    first = headers.groupBy("header").agg(F.min(F.struct("file", "sheet", "col")).alias("seen")).orderBy("seen")
    rows = (first if limit is None else first.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} distinct headings; check the header row")
    return [r["header"] for r in rows]


def neighbour_of_label(cells: DataFrame, pattern: str, name: str, max_rows: int = 10) -> DataFrame:
    """Text right of the first label matching ``pattern`` in the top rows of each sheet.

    Labels without text beside them are passed over.
    """
    top = filled(cells.filter(F.col("row") < max_rows))
    line = Window.partitionBy(*SHEET, "row").orderBy("col")
    pairs = top.select(
        *SHEET,
        "row",
        "col",
        "value",
        F.lead("col").over(line).alias("_next_col"),
        F.lead("value").over(line).alias("_next"),
    )
    text = strip(F.col("_next"))
    return (
        pairs.filter(F.col("value").rlike(f"(?i){pattern}"))
        .filter((F.col("_next_col") == F.col("col") + 1) & (text != "") & (F.lower(text) != "nan"))
        .groupBy(*SHEET)
        .agg(F.min_by(text, F.struct("row", "col")).alias(name))
    )


def common_layout(headers: DataFrame, limit: int | None = None) -> tuple[list[str], list[str]]:
    """Base headings and extra headings over sheets of differing width.

    The base width is the most frequent one (the earliest sheet decides a tie), the earliest
    sheet of that width names the base columns, and other widths add headings not among them
    in order of first appearance. Only distinct heading names reach the driver; more than
    ``limit`` of them, if given, is an error, not a cut.
    """
    sheets = headers.groupBy(*SHEET).agg(
        F.count(F.lit(1)).alias("width"),
        F.sort_array(F.collect_list(F.struct("col", "header"))).alias("columns"),
    )
    base = (
        sheets.groupBy("width")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "sheet", "columns")).alias("ref"))
        .orderBy(F.desc("n"), "ref.file", "ref.sheet")
        .select("width", F.col("ref.columns.header").alias("names"))
        .first()
    )
    if base is None:
        return [], []
    names = list(base["names"])
    others = (
        sheets.filter(F.col("width") != base["width"])
        .select(*SHEET, F.posexplode("columns.header").alias("col", "header"))
        .filter(~F.col("header").isin(*names))
    )
    return names, heading_list(others, limit)


def positional_headers(headers: DataFrame, base: Sequence[str]) -> DataFrame:
    """Give sheets of the base width the base names by position; other sheets keep theirs."""
    sheet = Window.partitionBy(*SHEET)
    names = F.array(*[F.lit(n) for n in base])
    return (
        headers.withColumn("_width", F.count(F.lit(1)).over(sheet))
        .withColumn("_at", F.row_number().over(sheet.orderBy("col")))
        .withColumn(
            "header",
            F.when(F.col("_width") == len(base), F.element_at(names, F.least("_at", F.lit(len(base))))).otherwise(
                F.col("header")
            ),
        )
        .drop("_width", "_at")
    )


# --- records -----------------------------------------------------------------------------


def is_ordinary(headers: DataFrame) -> Column:
    """Headings that are neither dates nor among the columns after the last date."""
    ordinary = F.lit(True)
    for column in ("date", "offset"):
        if column in headers.columns:
            ordinary = ordinary & F.col(column).isNull()
    return ordinary


def layouts(headers: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """One row per sheet: heading -> column position, and the date columns in order.

    Ordinary headings must be unique per sheet (see :func:`duplicate_headers`); date columns
    and the columns after them are kept by position, so equal ones all stay. ``roles`` maps a
    role to a pattern; the first ordinary heading whose normalised text matches plays it.
    """
    has_dates = "date" in headers.columns
    ordinary = is_ordinary(headers)
    if roles:
        headers = headers.withColumn("_key", F.when(ordinary, norm_key(F.col("header"))))
    aggregates = [
        *[F.min(F.when(F.col("_key").rlike(p), F.col("col"))).alias(f"role_{r}") for r, p in (roles or {}).items()],
        F.min("header_row").alias("header_row"),
        F.map_from_entries(F.collect_list(F.when(ordinary, F.struct("header", "col")))).alias("columns"),
        F.min("col").alias("first_col"),
        F.max("col").alias("last_col"),
    ]
    if has_dates:
        aggregates.append(
            F.sort_array(
                F.collect_list(F.when(F.col("date").isNotNull(), F.struct("col", "date")))
            ).alias("dates")
        )
    if "offset" in headers.columns:
        aggregates.append(
            F.map_from_entries(
                F.collect_list(F.when(F.col("offset").isNotNull(), F.struct("offset", "col")))
            ).alias("tail")
        )
    return headers.groupBy(*SHEET).agg(*aggregates)


def records(cells: DataFrame) -> DataFrame:
    """One row per spreadsheet row with its cells as ``col -> value``; empty rows vanish.

    The only shuffle of the cells; a row's cells lie together in the input, so most of the
    grouping happens before it. Empty cells are left out while grouping, not by a filter: a
    filter on a cleaned value would be moved below the cleaning and run it twice. Spark sorts the
    cells by the grouping columns; the row number comes first, as it settles most comparisons and file names do not.
    """
    entry = F.when(F.trim("value") != "", F.struct("col", "value"))
    return (
        cells.groupBy("row", *SHEET)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
        .filter(F.size("cells") > 0)
        .select(*SHEET, "row", "cells")
    )


def with_layout(cells: DataFrame, layout: DataFrame, entries: Column | None = None) -> DataFrame:
    """Records below each sheet's header row, with the sheet's layout.

    The layouts are computed and written once. ``entries`` is the number of headings a layout
    row holds; their total decides whether they are broadcast. If so, cells of other sheets
    and above the header are dropped before the shuffle that builds the records.
    """
    written = stage(layout, "layouts")
    if entries is None:
        entries = F.size("columns")
        if "dates" in layout.columns:
            entries = entries + F.size("dates")
    below = F.col("row") > F.col("header_row")
    if fits_broadcast(written, entries=entries):
        heads = written.select(*SHEET, "header_row")
        body = cells.join(F.broadcast(heads), SHEET).filter(below).drop("header_row")
        return records(body).join(F.broadcast(written), SHEET)
    return join_lookup(records(cells), written, SHEET, "inner", rows=0).filter(below)


def cell(title: str) -> Column:
    """Value of a data record under a heading, null when the sheet lacks the heading."""
    return F.col("cells")[F.col("columns")[title]]


def first_cell(*titles: str) -> Column:
    """Value under the first of several headings that the sheet has."""
    return F.coalesce(*[F.when(F.col("columns")[t].isNotNull(), cell(t)) for t in titles])


def tail_cell(offset: int) -> Column:
    """Value in the n-th column after the last date column."""
    return F.col("cells")[F.col("tail")[offset]]


def wide(data: DataFrame, titles: Sequence[str], carry: Sequence[str] = ("file", "sheet", "row")) -> DataFrame:
    """Records to a wide table with a known list of headings."""
    return data.select(*carry, *[cell(t).alias(t) for t in titles])


def dated_marks(data: DataFrame, ids: Mapping[str, Column]) -> DataFrame:
    """One row per record and date column: ids, ``fecha`` and the mark, null when empty."""
    # A step with a lambda is compiled apart from the ones after it. In one piece with them, the ids' cleaning makes a
    # method so large (over 8,000 bytes) that the JVM only interprets it.
    dates = F.transform("dates", lambda d: F.struct(d["col"].alias("_col"), d["date"].alias("_date")))
    once = data.select(*[c.alias(n) for n, c in ids.items()], F.col("cells").alias("_cells"), dates.alias("_dates"))
    names = [F.col(f"`{n}`") for n in ids]
    # The cells are read after the dates are unrolled: an array of marks would be computed by interpreted lambdas.
    # A layout has at least one date, so the outer form adds no row.
    long = once.select(*names, "_cells", F.inline_outer("_dates"))
    return long.select(*names, F.col("_date").alias("fecha"), F.col("_cells")[F.col("_col")].alias("asistencia"))


def unroll(
    data: DataFrame, ids: Mapping[str, Column], marks: Column, inline: Callable[[Column], Column] = F.inline
) -> DataFrame:
    """One row per element of an array of structs, beside the ids.

    The ids are computed in a step of their own, once per record and not once per element.
    """
    once = data.select(*[c.alias(n) for n, c in ids.items()], marks.alias("_marks"))
    return once.select(*[F.col(f"`{n}`") for n in ids], inline(F.col("_marks")))


def titled_marks(
    data: DataFrame, ids: Mapping[str, Column], pattern: str, name: str, value: str
) -> DataFrame:
    """One row per record and heading matching ``pattern``: ids, heading and cell."""
    chosen = F.filter(F.map_entries("columns"), lambda e: e["key"].rlike(pattern))
    marks = F.transform(
        chosen, lambda e: F.struct(e["key"].alias(name), F.col("cells")[e["value"]].alias(value))
    )
    return unroll(data, ids, marks)


def is_repeated_header(titles: Sequence[str], values: Column) -> Column:
    """Whether at least half of the columns (one at least) repeat a column title."""
    names = F.array(*[F.lit(t) for t in titles])
    hits = F.size(F.filter(values, lambda v: F.array_contains(names, v)))
    return hits >= max(1, len(titles) // 2)
