"""State per key carried from run to run: every run reads only the files that are new.

A run is a stream over a folder that takes the files present and ends. Spark's checkpoint of the stream is the manifest of
files read: none is left out or counted twice, also where a run fails midway. Each batch of files is reduced
to one row per key, merged into the state, and written as its next version. A batch that is run again after a
failure starts from the same version and writes the same one.

The state is stored in buckets by key, so it is never shuffled: what moves is a row per key of the new files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.sources.by_key import read_by_key, write_by_key
from aulario.sources.versioned_load import filesystem

# Null keys are one key of the state, so it is stored by a text that is never null.
_KEY = "_key"
_LATEST = "_latest"


@dataclass(frozen=True)
class KeyState:
    """What is kept per key: least and greatest values and sums of SQL expressions, and one whole row, the latest.

    ``latest`` lists columns of the row to keep: the date that decides, then what breaks ties, in order. A null
    date wins, as in the latest answer per person, or loses with ``null_wins=False``. Null values never count
    as least, greatest or in a sum. Rows without a key count as one key.
    """

    key: str
    least: Mapping[str, str] = field(default_factory=dict)
    most: Mapping[str, str] = field(default_factory=dict)
    total: Mapping[str, str] = field(default_factory=dict)
    latest: Sequence[str] = ()
    null_wins: bool = True

    def reduced(self, df: DataFrame) -> DataFrame:
        """One row of state per key of ``df``; a frequent key is reduced where its rows lie."""
        key = F.col(f"`{self.key}`")
        text = F.when(key.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), key.cast("string")))
        wanted = [F.max(key).alias(self.key)]
        wanted += [F.min(F.expr(v)).alias(n) for n, v in self.least.items()]
        wanted += [F.max(F.expr(v)).alias(n) for n, v in self.most.items()]
        wanted += [F.sum(F.expr(v)).alias(n) for n, v in self.total.items()]
        if self.latest:
            unknown = F.col(f"`{self.latest[0]}`").isNull()
            rank = unknown if self.null_wins else ~unknown
            row = F.struct(rank.alias("_rank"), *[F.col(f"`{c}`") for c in self.latest])
            wanted.append(F.max(row).alias(_LATEST))
        return df.groupBy(text.alias(_KEY)).agg(*wanted)

    def merged(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """State after both, where each has a row per key."""
        a, b = old.alias("a"), new.alias("b")

        def both(name: str, pick) -> Column:
            return pick(F.col(f"a.`{name}`"), F.col(f"b.`{name}`")).alias(name)

        def added(x: Column, y: Column) -> Column:
            return F.coalesce(x + y, x, y)

        picks = {_KEY: F.coalesce, self.key: F.coalesce, **dict.fromkeys(self.least, F.least)}
        picks |= {**dict.fromkeys(self.most, F.greatest), **dict.fromkeys(self.total, added)}
        if self.latest:
            picks[_LATEST] = F.greatest
        columns = [both(n, pick) for n, pick in picks.items()]
        return a.join(b, F.col(f"a.{_KEY}") == F.col(f"b.{_KEY}"), "full").select(*columns)

    def rows(self, state: DataFrame) -> DataFrame:
        """The state as a plain table: the key, the values, the columns of the latest row."""
        values = [F.col(f"`{n}`") for n in (*self.least, *self.most, *self.total)]
        kept = [F.col(f"{_LATEST}.`{c}`") for c in self.latest if c != self.key]
        return state.select(F.col(f"`{self.key}`"), *values, *kept)


def new_files(spark: SparkSession, folder: str, schema: T.StructType, per_batch: int | None = None) -> DataFrame:
    """Stream over the Parquet files of a folder, at most ``per_batch`` files in a batch.

    Files are never held too old: one that arrives late is read like any other.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def carry(source: DataFrame, state: KeyState, folder: str, buckets: int = 64) -> DataFrame:
    """Take what is new in the stream ``source`` into the state in ``folder``, and return the state's rows.

    ``buckets`` may change between runs; the state is then stored anew once. ``folder`` must be one that all executors reach. One run at a time.
    """
    spark = source.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        fresh = state.reduced(batch)
        if number:
            # Fails where the version before is missing, rather than to begin anew.
            fresh = state.merged(_version(spark, folder, number - 1, fresh.schema), fresh)
        write_by_key(fresh, _KEY, f"{folder}/versions/{number:09d}-{buckets}", buckets)
        _forget(folder, number - 1)

    stream = source.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    empty = state.reduced(spark.createDataFrame([], source.schema))
    last = max(_versions(folder), default=None)
    return state.rows(empty if last is None else _version(spark, folder, last, empty.schema))


def _versions(folder: str) -> dict[int, list[str]]:
    """Whole versions of a state: number -> names of folders."""
    system, root = filesystem(folder)
    found: dict[int, list[str]] = {}
    for info in system.get_file_info(fs.FileSelector(f"{root}/versions", allow_not_found=True)):
        if system.get_file_info(f"{info.path}/_SUCCESS").type == fs.FileType.File:
            found.setdefault(int(info.base_name.split("-")[0]), []).append(info.base_name)
    return found


def _version(spark: SparkSession, folder: str, number: int, schema: T.StructType) -> DataFrame:
    names = _versions(folder).get(number)
    if not names:
        raise FileNotFoundError(f"{folder} has no version {number} of its state")
    # A batch that was run again in another number of buckets left the same rows twice, in two folders.
    return read_by_key(spark, _KEY, f"{folder}/versions/{names[0]}", int(names[0].split("-")[1]), schema)


def _forget(folder: str, before: int) -> None:
    """Drop versions older than ``before``, which a batch that is run again would start from."""
    system, root = filesystem(folder)
    for number, names in _versions(folder).items():
        if number < before:
            for name in names:
                system.delete_dir(f"{root}/versions/{name}")
