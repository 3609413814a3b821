"""CSV records whose cells may hold line breaks, read in parallel blocks of large files.

A line only tells where a record ends if one knows whether it starts inside a quoted cell. So the files are
read twice, as lines, by Spark's own splits:

1. Every block (the lines of one split of one file) is summed up as a function of that unknown: is a record
   open after the block if none was before it, and if one was? These functions are composed along
   each file, which gives every block its true entering state. The files' headers come from the same pass.
2. With its state known, each block is cut into records by itself. Records that lie in one block never
   move; pieces of a record that crosses a block's edge are brought together by the block it began in.

Quotes follow the usual rules: a cell is quoted if it begins with a quote, a quote inside it is
doubled, and quotes elsewhere are plain characters. Lines end in LF or CR LF.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.sources.stages import stage
from aulario.sources.workers import package_on_workers

# Blocks and distinct headers that one read may have; both are known before anything is broadcast.
MAX_BLOCKS = 2_000_000
MAX_LAYOUTS = 10_000
_CELL = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
_ENDS_IF_CLOSED = rf"^{_CELL}(?:,{_CELL})*$"
_ENDS_IF_OPEN = rf'^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_CELL})*$'
_SUMMARY = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("if_closed", pa.bool_()),
        ("if_open", pa.bool_()),
        ("stays", pa.bool_()),
        ("blank", pa.bool_()),
        ("header", pa.string()),
    ]
)
_PIECES = pa.schema(
    [("path", pa.string()), ("name", pa.string()), ("opener", pa.int64()), ("start", pa.int64()), ("first", pa.bool_()), ("record", pa.string())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def transitions(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether a record is open after each line: (if none was open before it, if one was)."""
    if_closed, if_open = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
    if quoted.any():
        some = lines.filter(pa.array(quoted))
        if_closed[quoted] = ~pc.match_substring_regex(some, _ENDS_IF_CLOSED).to_numpy(zero_copy_only=False)
        if_open[quoted] = ~pc.match_substring_regex(some, _ENDS_IF_OPEN).to_numpy(zero_copy_only=False)
    return if_closed, if_open


def states(if_closed: np.ndarray, if_open: np.ndarray, entering: bool) -> np.ndarray:
    """Whether a record is open after each line, from the state before the first one.

    A line forgets the state, keeps it or turns it: the last line that forgot it decides, with the turns since.
    """
    turns = np.cumsum(if_closed & ~if_open)
    at = np.maximum.accumulate(np.where(if_closed == if_open, np.arange(len(turns)), -1))
    known = at >= 0
    base = np.where(known, if_closed[at], entering)
    return base ^ ((turns - np.where(known, turns[at], 0)) % 2 == 1)


def _runs(incoming: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Consecutive lines of one block."""
    if not incoming.num_rows:
        return
    codes = incoming.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = incoming.column(1).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    for i, j in zip([0, *edges], [*edges, len(codes)]):
        yield incoming.column(0)[int(i)].as_py(), int(starts[i]), incoming.slice(int(i), int(j - i))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; ``header`` is the first record of a file's first block."""
    current: tuple[str, int] | None = None
    if_closed, if_open, stays, blank = False, True, True, True
    parts: list[str] | None = None
    header: str | None = None

    def row() -> pa.RecordBatch:
        values = [*current, if_closed, if_open, stays, blank, header]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SUMMARY)], schema=_SUMMARY)

    for incoming in batches:
        for path, start, some in _runs(incoming):
            if (path, start) != current:
                if current is not None:
                    yield row()
                current = (path, start)
                if_closed, if_open, stays, blank = False, True, True, True
                parts, header = ([] if start == 0 else None), None
            lines = some.column(2)
            from_closed, from_open = transitions(lines)
            after = [states(from_closed, from_open, state) for state in (if_closed, if_open)]
            for i in range(len(lines)) if parts is not None else ():
                line = lines[i].as_py()
                if parts or line.strip():
                    parts.append(line)
                    if not after[0][i]:
                        header, parts = "\n".join(parts), None
                        break
            if_closed, if_open = bool(after[0][-1]), bool(after[1][-1])
            stays = stays and bool(from_open.all())
            blank = blank and bool(pc.all(pc.equal(pc.utf8_trim_whitespace(lines), "")).as_py())
    if current is not None:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block; pieces of records that cross its edges have an ``opener``."""
    current: tuple[str, int] | None = None
    name, state, opener, carried, carried_first, head = "", False, None, [], False, False

    def piece(record: str, first: bool, begun_in: int | None) -> pa.RecordBatch:
        values = [current[0], name, begun_in, current[1], first, record]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _PIECES)], schema=_PIECES)

    def rest() -> pa.RecordBatch:
        """What is still open where a block ends."""
        return piece("\n".join(carried), carried_first, opener if head else current[1])

    for incoming in batches:
        for path, start, some in _runs(incoming):
            if (path, start) != current:
                if carried:
                    yield rest()
                current, carried, carried_first = (path, start), [], False
                name, state, opener = (some.column(i)[0].as_py() for i in (3, 4, 5))
                head, wanted = state, start == 0
            lines = some.column(2)
            after = states(*transitions(lines), state)
            before = np.r_[state, after[:-1]]
            state = bool(after[-1])
            first = np.zeros(len(lines), bool)
            if wanted:
                begins = np.flatnonzero(~before & ~pc.equal(pc.utf8_trim_whitespace(lines), "").to_numpy(zero_copy_only=False))
                if len(begins):
                    first[begins[0]], wanted = True, False
            alone = ~before & ~after
            if alone.any():
                taken = lines.filter(pa.array(alone))
                n = len(taken)
                nothing = pa.nulls(n, pa.int64())
                columns = [pa.repeat(pa.scalar(path), n), pa.repeat(pa.scalar(name), n), nothing, nothing, pa.array(first[alone]), taken]
                yield pa.RecordBatch.from_arrays(columns, schema=_PIECES)
            many = np.flatnonzero(~alone)
            if not len(many):
                continue
            # Lines of records of several lines: the first may go on from before, the last may stay open.
            ends = np.flatnonzero(~after[many]) + 1
            at = 0
            if carried or before[many[0]]:
                at = int(ends[0]) if len(ends) else len(many)
                carried += lines.take(pa.array(many[:at])).to_pylist()
                if len(ends):
                    yield piece("\n".join(carried), carried_first, opener if head else None)
                    carried, carried_first, head = [], False, False
                    ends = ends[1:]
            if len(ends):
                offsets = np.r_[at, ends].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets - at), lines.take(pa.array(many[at : ends[-1]])))
                joined = pc.binary_join(lists, "\n")
                n = len(joined)
                nothing = pa.nulls(n, pa.int64())
                columns = [pa.repeat(pa.scalar(path), n), pa.repeat(pa.scalar(name), n), nothing, nothing, pa.array(first[many[offsets[:-1]]]), joined]
                yield pa.RecordBatch.from_arrays(columns, schema=_PIECES)
                at = int(ends[-1])
            if at < len(many):
                carried, carried_first = lines.take(pa.array(many[at:])).to_pylist(), bool(first[many[at]])
    if carried:
        yield rest()


@dataclass
class CsvRecords:
    """``records`` (path, name, first, record) and ``files`` (path, header), one row per file with a record."""

    records: DataFrame
    files: DataFrame


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    found = spark.read.option("lineSep", "\n").text(list(paths))
    at = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    return found.select(*at, "value", decoded(F.col("_metadata.file_name")).alias("name"))


def decoded(path: Column) -> Column:
    """A path or file name without the escapes of its URI form."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def _entering(summaries: DataFrame) -> DataFrame:
    """State before and after each block, and the block in which the record open before it began."""
    along = Window.partitionBy("path").orderBy("start")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum((F.col("if_closed") & ~F.col("if_open")).cast("long")).over(so_far)
    forgot = F.when(F.col("if_closed") == F.col("if_open"), F.struct(F.col("if_closed").alias("then"), "turns"))
    told = summaries.withColumn("turns", turns).withColumn("last", F.last(forgot, ignorenulls=True).over(so_far))
    odd = (F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    told = told.withColumn("after", F.coalesce("last.then", F.lit(False)) != odd)
    told = told.withColumn("open", F.lag("after", 1, False).over(along))
    begins = F.when(~(F.col("open") & F.col("stays")), F.col("start"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return told.withColumn("opener", F.last(begins, ignorenulls=True).over(earlier))


def csv_records(spark: SparkSession, paths: Sequence[str]) -> CsvRecords:
    """Records of CSV files, one row each whatever lines they span; blank ones are left out.

    A quote that is never closed is an error, and so is a file whose first split is blank while others are not.
    """
    package_on_workers(spark)
    lines = _lines(spark, paths)
    blocks = stage(_entering(lines.select("path", "start", "value").mapInArrow(_summaries, _ddl(_SUMMARY))), "csv-blocks")
    if blocks.count() > MAX_BLOCKS:
        raise ValueError(f"more than {MAX_BLOCKS} blocks to read at once; raise spark.sql.files.maxPartitionBytes")
    unclosed = blocks.groupBy("path").agg(F.max_by("after", "start").alias("open")).filter("open").first()
    if unclosed is not None:
        raise ValueError(f"a quoted cell is never closed in {unclosed.path}")
    known = F.broadcast(blocks.select("path", "start", "open", "opener"))
    # Splits of another run may differ; a block without a state is an error rather than a guess.
    state = F.when(F.col("open").isNull(), F.raise_error(F.concat(F.lit("splits changed between two reads of "), "path")).cast("boolean"))
    fed = lines.join(known, ["path", "start"], "left").select(
        "path", "start", "value", "name", state.otherwise(F.col("open")).alias("open"), "opener"
    )
    pieces = fed.mapInArrow(_cut, _ddl(_PIECES))
    columns = ["path", "name", "first", "record"]
    records = pieces.select(*columns)
    if not blocks.filter("open").isEmpty():
        joined = (
            pieces.filter("opener is not null")
            .groupBy("path", "opener")
            .agg(F.first("name").alias("name"), F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
            .withColumn("record", F.array_join(F.col("parts.record"), "\n"))
        )
        records = pieces.filter("opener is null").select(*columns).unionByName(joined.select(*columns))
    records = records.filter(F.trim(F.col("record"), F.lit(" \t\r\n")) != "")
    files = blocks.filter("header is not null").select("path", "header")
    begins = (F.col("start") == 0) & ~F.col("blank")
    per_file = blocks.groupBy("path").agg(*[F.bool_or(c).alias(n) for n, c in (("named", F.col("header").isNotNull()), ("full", ~F.col("blank")), ("begins", begins))])
    headless = per_file.filter("full and not named")
    wrong = headless.filter("not begins").first()
    if wrong is not None:
        raise ValueError(f"no header in the first split of {wrong.path}")
    if not headless.isEmpty():  # headers that cross the edge of a split are read as records
        longer = records.filter("first").join(F.broadcast(headless.select("path")), "path", "left_semi")
        files = stage(files.unionByName(longer.select("path", F.col("record").alias("header"))), "csv-headers")
    return CsvRecords(records.withColumn("record", F.rtrim(F.col("record"), F.lit("\r"))), files)


def header_names(header: str) -> list[str]:
    """Column names of a header record, without a byte mark."""
    return next(csv.reader(io.StringIO(header.removeprefix("﻿").rstrip("\r"), newline="")))


def layouts(files: DataFrame) -> dict[str, list[str]]:
    """Names by distinct header, in the order of the first file that has it; too many are an error."""
    found = files.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").limit(MAX_LAYOUTS + 1).collect()
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers")
    return {r.header: header_names(r.header) for r in found}


def fields(record: Column, width: int) -> Column:
    """A record's cells as an array of ``width`` texts; missing and empty ones are null."""
    names = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = F.from_csv(record, schema.simpleString()[len("struct<") : -1].replace(":", " "), {"escape": '"', "maxColumns": str(max(width, 20480))})
    return F.array(*[parsed[n] for n in names])
