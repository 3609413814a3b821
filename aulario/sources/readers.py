"""Scans: cell grids, CSV folders with text ids, optional yearly inputs."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.functions.text import norm_key
from aulario.operators.combine import union_aligned
from aulario.sources.quoted_csv import csv_records, decoded, fields, layouts

CELL_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)


def drop_temporary(df: DataFrame, name: str = "file") -> DataFrame:
    """Leave out lock files an open office program writes next to a workbook (``~$…``).

    Rows without a file name stay.
    """
    lock = F.regexp_extract(F.col(name), r"([^/]*)$", 1).startswith("~$")
    return df.filter(~F.coalesce(lock, F.lit(False)))


def _groups(paths: Sequence[str]) -> list[list[str]]:
    """Paths that are read together: those of one folder, so that types need only agree within it."""
    out: dict[str, list[str]] = {}
    for path in paths:
        out.setdefault(path if "." not in posixpath.basename(path.rstrip("/")) else posixpath.dirname(path.rstrip("/")), []).append(path)
    return list(out.values())


# Start of a path that names a file system, and folders that hold a column of the grid.
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"
_OWN_COLUMN = f"^({'|'.join(CELL_SCHEMA.names)})="


def _components(path: str) -> list[str]:
    """Parts of a file's path that may tell its folder."""
    return [x for x in re.sub(_SCHEME, "/", path).split("/")[:-1] if not re.match(_OWN_COLUMN, x)]


def _relative_folder(path: Column, files: Sequence[str]) -> Column:
    """What tells a file's folder from those of the other files, with a closing slash; empty in one common folder."""
    folders = {tuple(_components(f)) for f in files}
    if len(folders) < 2:
        return F.lit("")
    shared = 0
    for parts in zip(*folders):
        if len(set(parts)) > 1:
            break
        shared += 1
    parts = F.split(F.regexp_replace(decoded(path), _SCHEME, "/"), "/")
    parts = F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: ~x.rlike(_OWN_COLUMN))
    own = F.slice(parts, F.lit(shared + 1), F.greatest(F.size(parts), F.lit(shared)) - shared)
    return F.when(F.size(own) > 0, F.concat(F.array_join(own, "/"), F.lit("/"))).otherwise(F.lit(""))


def _csv_cells(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Cells of CSV files (and their ``_path``), columns by the header of each file whatever their order, number and case.

    Records equal to their file's first one are repeated headers. A file whose first record does not
    name each needed column once is an error when its rows are read.
    """
    read = csv_records(spark, paths)
    by_header = layouts(read.files)
    width = max(map(len, by_header.values()), default=1)
    needed = CELL_SCHEMA.names
    places = []
    for header, names in by_header.items():
        found = [n.strip().lower() for n in names]
        right = all(found.count(n) == 1 or (n == "file" and n not in found) for n in needed)
        places.append((header, right, *[found.index(n) + 1 if n in found else 0 for n in needed]))
    schema = T.StructType([T.StructField("header", T.StringType()), T.StructField("_right", T.BooleanType())])
    for n in needed:
        schema = schema.add(f"_{n}", T.IntegerType())
    known = read.files.join(F.broadcast(spark.createDataFrame(places, schema)), "header")
    # A file without a header in its first block has no row of its own and fails like one with a wrong header.
    error = F.raise_error(F.concat(F.lit("no header with sheet, row, col and value, each once, in "), "path"))
    body = read.records.join(F.broadcast(known), "path", "left")
    body = body.filter(F.when(F.coalesce("_right", F.lit(False)), F.lit(True)).otherwise(error.cast("boolean")))
    body = body.filter(F.col("record") != F.rtrim(F.col("header"), F.lit("\r"))).withColumn("_values", fields(F.col("record"), width))

    def value(column: str) -> Column:
        at = F.col(f"_{column}")
        return F.when(at > 0, F.get("_values", at - 1))

    rest = [value(n).alias(n) for n in needed if n != "file"]
    return body.select(F.coalesce(value("file"), F.col("name")).alias("file"), *rest, F.col("path").alias("_path"))


def scan_cells(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Read cell grids from folders or files of Parquet or CSV.

    Each row keeps the workbook it came from in ``file``; a row without one takes the name of
    its data file. Columns are found by name, whatever their order and case in a file; a CSV file
    without such a header is an error, and its cells may hold line breaks and doubled quotes. Where the data files
    lie in several folders (two years, say), ``file`` begins with what tells the folders
    apart, so equal names in two folders stay two workbooks, whether the folders are listed, found by a pattern or
    lie below one path. The declared schema means no
    inference of types, and filters on ``row``, ``col`` and ``sheet`` reach the Parquet scan.
    """
    paths = [path] if isinstance(path, str) else list(path)
    read, files = [], []
    for some in _groups(paths):
        if fmt == "csv":
            raw = _csv_cells(spark, some)
            files += spark.read.text(some).inputFiles()
        else:
            raw = spark.read.format(fmt).option("mergeSchema", True).load(some)
            files += raw.inputFiles()
            name = decoded(F.col("_metadata.file_name"))
            where = F.col("_metadata.file_path").alias("_path")
            raw = raw.select("*", where).withColumn("file", F.coalesce(F.col("file"), name) if "file" in raw.columns else name)
        read.append(raw)
    parts = []
    for raw in read:
        typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CELL_SCHEMA]
        typed[0] = F.concat(_relative_folder(F.col("_path"), files), typed[0]).alias("file")
        parts.append(raw.select(*typed))
    return drop_temporary(union_aligned(parts).filter(F.col("value").isNotNull()))


def _safe_names(names: Sequence[str]) -> list[str]:
    """Names as a reader gives them: numbered where empty or repeated (whatever the case)."""
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def scan_text_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Read CSV files with every column as text, so ids keep their leading zeros.

    Each file's first record is its header. ``columns`` declares the layout by position instead of it; otherwise
    columns are found by each file's own header, and one absent from a file is null. Cells may hold
    line breaks and doubled quotes, and large files are split all the same. All files are read in one scan, whatever their
    layouts.
    """
    if not paths:
        raise FileNotFoundError("no CSV input given")
    read = csv_records(spark, paths)
    body = read.records.filter(~F.col("first"))
    if columns is not None:
        return body.select(fields(F.col("record"), len(columns)).alias("_values")).select(
            *[F.get("_values", F.lit(i)).alias(c) for i, c in enumerate(columns)]
        )
    by_header = {h: _safe_names(n) for h, n in layouts(read.files).items()}
    names = list(dict.fromkeys(n for found in by_header.values() for n in found))
    width = max(map(len, by_header.values()), default=1)
    if len(by_header) == 1:
        places = {n: F.lit(i) for i, n in enumerate(names)}
        body = body.select(fields(F.col("record"), width).alias("_values"))
    else:
        rows = [(h, i, [found.index(n) if n in found else -1 for n in names]) for i, (h, found) in enumerate(by_header.items())]
        known = spark.createDataFrame(rows, "header string, _layout int, _at array<int>")
        by_file = read.files.join(F.broadcast(known.select("header", "_layout")), "header").select("path", "_layout")
        body = body.join(F.broadcast(by_file), "path").join(F.broadcast(known.select("_layout", "_at")), "_layout")
        body = body.select(fields(F.col("record"), width).alias("_values"), "_at")
        places = {n: F.get("_at", F.lit(i)) for i, n in enumerate(names)}
    return body.select(*[F.when(at >= 0, F.get("_values", at)).alias(n) for n, at in places.items()])


def sheet_like(pattern: str) -> Column:
    """Sheets whose normalised name matches a pattern (``asist``)."""
    return norm_key(F.col("sheet")).rlike(pattern)


def sheet_numbered() -> Column:
    """Sheets whose name starts with one or two digits."""
    return F.col("sheet").rlike(r"^\s*\d{1,2}")


def sheet_in(names: Sequence[str]) -> Column:
    return F.col("sheet").isin(*names)


def read_years(
    read: Callable[[str], DataFrame], paths: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Open one input per year, leaving out years whose path does not exist.

    No readable year at all is an error.
    """
    found = {}
    for year, path in paths.items():
        try:
            found[year] = read(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise FileNotFoundError(f"no input found for any of {sorted(paths)}")
    return found
