"""Shared helpers of the training-data operators: tables, words, hashes, stored files."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aulario.sources.stages import stage_folder

# Bytes of words; text is split at ASCII white space, the complement of [^\x20\x09-\x0D]+.
_SPACE = b" \t\n\x0b\x0c\r"
# Words remembered per Python worker, and word hashes. An entry takes some 200 bytes.
MEMO_WORDS = 400_000
MEMO_HASHES = 150_000
# Rows a Python worker is handed at once, so that a batch of long texts fits its memory.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Keep Arrow batches small in this session, of about ``size`` bytes: texts may be long.

    Python workers of a local session also learn where this package lies; on a cluster it is
    deployed with the job.
    """
    context = spark.sparkContext
    if context.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def one_text_per_id(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``chosen`` (``doc_id`` and more) with ``data``, the text of that document.

    Of an id that several documents share, only the text that is smallest by its bytes counts, so
    there are no more rows than in ``chosen``, which is small and broadcast. Ids without a document have no row.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy(*chosen.columns).agg(F.min("data").alias("data"))
    return staged(found, "labelled")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder of the session."""
    return f"{stage_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def pieces_at_spaces(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """Cut bytes at ASCII white space into pieces of about ``size``; nothing is lost.

    A word longer than ``size`` stays whole.
    """
    start, n = 0, len(data)
    while n - start > size:
        end = start + size
        while end < n and data[end] not in _SPACE:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered within a worker and emptied when full."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_HASHES:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = WordHashes()
# What operators remember in a worker between tasks, and how it is emptied.
MEMORIES: dict[str, Callable[[], None]] = {"hashes": _HASHES.clear}


def drop_memos(keep: str = "") -> None:
    """Empty what other operators remember in this worker, which may have worked for them before.

    The memory that this and earlier tasks freed goes back to the system: allocators keep it otherwise, and the
    next stage's JVM work finds it taken.
    """
    for name, empty in MEMORIES.items():
        if name != keep:
            empty()
    give_back()


def give_back() -> None:
    """Return freed memory of this process to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(data: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, A-Z lower-cased.

    With fewer than n words the whole sequence is one shingle; without words there is none.
    """
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < n:
        total = np.zeros(1, np.uint64)
        for h in hashes:
            total = mix(total * np.uint64(31) + h)
        return mix(total + np.uint64(len(words)))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - n + 1 + i]
    return np.unique(mix(total))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
