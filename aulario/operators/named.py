"""Records by heading: layouts as tables and records as maps, so that no list of headings reaches the driver.

``grid.common_layout`` and ``grid.wide`` need the headings as a list, since they become columns. Here they stay
rows of a table, a record holds ``heading -> value``, and columns are made at the very end, of chosen headings only.
Sheets may have any number of headings between them; one sheet's width bounds a record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.functions.text import norm_label
from aulario.operators.grid import SHEET
from aulario.operators.joins import join_lookup
from aulario.sources.stages import stage

RECORD = [*SHEET, "row"]


def numbered(df: DataFrame, by: str, name: str = "position") -> DataFrame:
    """Number rows 0, 1, 2... in the order of ``by``; they are sorted by ranges and never gathered in one task.

    The sorted rows are written once. What meets in one task is a count per range.
    """
    ordered = stage(df.orderBy(by).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    # The id holds the range above the lowest 33 bits and the place within it below.
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        ordered.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + place)
        .drop("_id", "_part", "_start")
    )


def named_layout(headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``names(position, header, base)`` and the headings of every sheet under their common names.

    The rules of ``grid.common_layout`` and ``grid.positional_headers``: the most frequent width is the base (the earliest
    sheet decides a tie and names its columns), sheets of that width take its names by position, other widths
    add the headings not among them in order of first appearance. Of equal headings of a sheet the first stays. One
    row, the base's width and sheet, reaches the driver. Reads ``headers`` several times: write them first.
    No headings give two empty tables.
    """
    sheet = Window.partitionBy(*SHEET)
    placed = headers.withColumn("_width", F.count(F.lit(1)).over(sheet)).withColumn(
        "_at", F.row_number().over(sheet.orderBy("col")) - 1
    )
    widths = headers.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("_width"))
    chosen = (
        widths.groupBy("_width")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*SHEET)).alias("ref"))
        .orderBy(F.desc("n"), "ref")
        .first()
    )
    if chosen is None:
        return headers.select(F.lit(0).cast("long").alias("position"), "header", F.lit(True).alias("base")), headers
    own = placed.filter((F.col("file") == chosen["ref"]["file"]) & (F.col("sheet") == chosen["ref"]["sheet"]))
    base = stage(own.select("_at", F.col("header").alias("_base")), "base")
    same = F.col("_width") == chosen["_width"]
    named = (
        join_lookup(placed, base, ["_at"], "left")
        .withColumn("header", F.when(same, F.col("_base")).otherwise(F.col("header")))
        .withColumn("_n", F.row_number().over(Window.partitionBy(*SHEET, "header").orderBy("col")))
        .filter("_n = 1")
        .select(*headers.columns)
    )
    first = base.groupBy(F.col("_base").alias("header")).agg(F.min("_at").cast("long").alias("position"))
    seen = F.min(F.struct(*SHEET, "col")).alias("seen")
    others = placed.filter(~same).join(first, "header", "left_anti").groupBy("header").agg(seen)
    extra = numbered(others, "seen").select((F.col("position") + chosen["_width"]).alias("position"), "header")
    names = first.select("position", "header", F.lit(True).alias("base")).unionByName(extra.withColumn("base", F.lit(False)))
    return names, named


def named_records(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per spreadsheet row below the header: ``file, sheet, row, fields`` (heading -> value); empty rows vanish.

    ``headers`` names the columns of each sheet, each name once. They meet the cells by sheet and column, by broadcast
    where they are few; a column of a huge sheet is spread over tasks otherwise (``join_lookup``).
    """
    at = stage(headers.select(*SHEET, "col", "header_row", "header"), "headings")
    entry = F.when(F.trim("value") != "", F.struct("header", "value"))
    return (
        join_lookup(cells, at, [*SHEET, "col"])
        .filter(F.col("row") > F.col("header_row"))
        .groupBy(*RECORD)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("fields"))
        .filter(F.size("fields") > 0)
    )


def headings_named(names: DataFrame, wanted: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """For each role the heading equal to the first of its wordings that occurs, up to accents, case, spacing and underscores.

    At most one heading per wording reaches the driver; of headings that are equal in this sense the last counts.
    """
    words = {w for some in wanted.values() for w in some}
    if not words:
        return {}
    keys = names.sparkSession.createDataFrame([(w,) for w in sorted(words)], "word string")
    keyed = keys.select("word", norm_label(F.col("word")).alias("_key"))
    found = (
        names.withColumn("_key", norm_label(F.col("header")))
        .join(F.broadcast(keyed), "_key")  # as many rows as wordings are given
        .groupBy("word")
        .agg(F.max_by("header", "position").alias("header"))
    )
    known = {r["word"]: r["header"] for r in found.collect()}
    hits = {role: next((known[w] for w in some if w in known), None) for role, some in wanted.items()}
    return {role: heading for role, heading in hits.items() if heading is not None}


def with_fields(records: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Replace the values under some headings; a null takes the heading out of the record."""
    if not changes:
        return records
    others = F.map_filter("fields", lambda k, v: ~k.isin(*changes))
    new = F.array(*[F.struct(F.lit(t).alias("key"), c.cast("string").alias("value")) for t, c in changes.items()])
    filled = F.map_from_entries(F.filter(new, lambda e: e["value"].isNotNull()))
    return records.withColumn("fields", F.map_concat(others, filled))


def without_repeated_headers(records: DataFrame, names: DataFrame, also: Mapping[str, Column] | None = None) -> DataFrame:
    """Drop records of which as many values as half of the columns (one at least) are titles of the table.

    ``also`` are columns beside the fields: their names are titles and their values count. Only records with that many
    values are compared, through a join with the titles. Reads ``records`` twice: write them first.
    """
    also = dict(also or {})
    least = max(1, (names.count() + len(also)) // 2)
    titles = names.select("header")
    if also:
        titles = titles.unionByName(records.sparkSession.createDataFrame([(t,) for t in also], "header string"))
    values = F.concat(F.map_values("fields"), F.array(*[c.cast("string") for c in also.values()]).cast("array<string>"))
    single = records.select(*RECORD, values.alias("_values")).filter(F.size("_values") >= least)
    single = single.select(*RECORD, F.explode("_values").alias("_value")).select(*RECORD, norm_label(F.col("_value")).alias("header"))
    repeated = (
        join_lookup(single, stage(titles.distinct(), "titles"), ["header"])
        .groupBy(*RECORD)
        .agg(F.count(F.lit(1)).alias("_hits"))
        .filter(F.col("_hits") >= least)
    )
    return records.join(repeated, RECORD, "left_anti")


def columns_of(records: DataFrame, titles: Sequence[str], carry: Sequence[str] = RECORD) -> DataFrame:
    """The chosen headings as columns, null where a record lacks one."""
    return records.select(*carry, *[F.col("fields")[t].alias(t) for t in titles])
