"""Data source that replaces a target atomically and keeps the outcome of every record.

A target folder holds versions and one file, ``CURRENT``, that names the version in force:

* ``versions/<version>/data``: JSON batches of accepted records, named by the batch's key and the attempt that wrote them;
* ``versions/<version>/results``: a row per record, accepted or rejected, with the key of its batch.

Tasks write into a version that nobody reads yet. The commit drops what other attempts of a task left behind, then
switches ``CURRENT`` in one step; an abort drops the new version. So a reader sees the old load or the new one,
whole, and the old one stays in force if a load fails. The version before the current one is
kept for readers that have begun.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

POINTER = "CURRENT"
# What the writer takes: a record as JSON, its key, and the reasons for which it is rejected.
INPUT = "record string, key string, errors array<string>"
RESULTS = "batch string, position long, key string, success boolean, errors array<string>"
_RESULTS = pa.schema(
    [("batch", pa.string()), ("position", pa.int64()), ("key", pa.string()), ("success", pa.bool_()), ("errors", pa.list_(pa.string()))]
)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    """What one attempt of a task wrote."""

    stem: str
    batches: int
    inserted: int
    failed: int


class LoadWriter(DataSourceArrowWriter):
    """Expects the columns of ``INPUT``."""

    def __init__(self, path: str, version: str, batch: int, schema: str) -> None:
        self.path, self.version, self.batch, self.schema = path, version, batch, schema

    def _folder(self) -> tuple[fs.FileSystem, str]:
        system, root = filesystem(self.path)
        return system, f"{root}/versions/{self.version}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = self._folder()
        for name in ("data", "results"):
            system.create_dir(f"{folder}/{name}")
        # A batch's key is the same in every attempt of its task; the file also names the attempt.
        part = f"{TaskContext.get().partitionId():06d}"
        stem = f"{part}-{uuid.uuid4().hex}"
        batches = inserted = failed = 0
        waiting: list[pa.RecordBatch] = []
        results: pq.ParquetWriter | None = None
        out = None

        def settle(some: pa.Table) -> None:
            nonlocal batches, inserted, failed, results, out
            errors = some.column("errors").combine_chunks()
            good = pc.equal(pc.fill_null(pc.list_value_length(errors), 0), 0)
            lines = some.column("record").filter(good).to_pylist()
            if lines:
                with system.open_output_stream(f"{folder}/data/{stem}-{batches:06d}.json") as f:
                    f.write(("\n".join(lines) + "\n").encode())
            n = some.num_rows
            columns = [pa.repeat(f"{part}-{batches:06d}", n), pa.array(range(n), pa.int64()), some.column("key"), good, errors]
            if results is None:
                out = system.open_output_stream(f"{folder}/results/{stem}.parquet")
                results = pq.ParquetWriter(out, _RESULTS)
            results.write_table(pa.Table.from_arrays(columns, schema=_RESULTS))
            batches, inserted, failed = batches + 1, inserted + len(lines), failed + n - len(lines)

        rows = 0
        for incoming in iterator:
            waiting.append(incoming)
            rows += incoming.num_rows
            if rows >= self.batch:
                table = pa.Table.from_batches(waiting)
                whole = rows - rows % self.batch
                for at in range(0, whole, self.batch):
                    settle(table.slice(at, self.batch))
                waiting, rows = table.slice(whole).to_batches(), rows - whole
        if rows:
            settle(pa.Table.from_batches(waiting))
        if results is not None:
            results.close()
            out.close()
        return Written(stem, batches, inserted, failed)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = self._folder()
        done = [m for m in messages if m is not None]
        stems = {m.stem for m in done}
        for name in ("data", "results"):
            system.create_dir(f"{folder}/{name}")
            for info in system.get_file_info(fs.FileSelector(f"{folder}/{name}")):
                if "-".join(info.base_name.split(".")[0].split("-")[:2]) not in stems:
                    system.delete_file(info.path)
        told = {"version": self.version, "schema": self.schema}
        told |= {k: sum(getattr(m, k) for m in done) for k in ("batches", "inserted", "failed")}
        _, root = filesystem(self.path)
        before = current(self.path)
        fresh = f"{root}/{POINTER}.{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as f:
            f.write(json.dumps(told).encode())
        system.move(fresh, f"{root}/{POINTER}")
        kept = {self.version, before["version"] if before else None}
        for info in system.get_file_info(fs.FileSelector(f"{root}/versions")):
            # Versions that began after this one belong to loads that are still running.
            if info.base_name not in kept and info.base_name < self.version:
                system.delete_dir(info.path)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = self._folder()
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class VersionedLoad(DataSource):
    """Options: ``path``, ``version``, ``batch`` (records in one), ``target_schema`` (of the records)."""

    @classmethod
    def name(cls) -> str:
        return "versioned_load"

    def schema(self) -> str:
        return INPUT

    def writer(self, schema: T.StructType, overwrite: bool) -> LoadWriter:
        o = self.options
        return LoadWriter(o["path"], o["version"], int(o["batch"]), o["target_schema"])


def new_version() -> str:
    """Names that sort by the time they were made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def current(path: str) -> dict | None:
    """What ``CURRENT`` says: version, schema of the records and counts; None before the first load."""
    system, root = filesystem(path)
    if system.get_file_info(f"{root}/{POINTER}").type != fs.FileType.File:
        return None
    with system.open_input_stream(f"{root}/{POINTER}") as f:
        return json.loads(f.read())


def _folder_of(path: str, part: str, told: dict) -> str:
    return f"{path.rstrip('/')}/versions/{told['version']}/{part}"


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """The records in force."""
    told = current(path)
    if told is None:
        raise FileNotFoundError(f"nothing has been loaded into {path}")
    schema = T.StructType.fromJson(json.loads(told["schema"]))
    if told["inserted"] == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(_folder_of(path, "data", told))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The outcome of every record of the load in force."""
    told = current(path)
    if told is None:
        raise FileNotFoundError(f"nothing has been loaded into {path}")
    if told["batches"] == 0:
        return spark.createDataFrame([], RESULTS)
    return spark.read.schema(RESULTS).parquet(_folder_of(path, "results", told))
