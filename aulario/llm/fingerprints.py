"""One-permutation MinHash fingerprints: one hash per shingle, optimal densification, packed bits.

A text's shingle hashes fall into ``BINS`` bins by their leading bits; the smallest of each bin
counts. An empty bin takes over a filled bin's value: it tries bins in the order of a hash of
(bin, attempt), the same for all texts, until one was filled. Of each value the lowest ``BITS`` bits
are kept. Two values of different shingles agree in those bits by chance, so the likeness is
(m - 2^-BITS) / (1 - 2^-BITS) for a share m of agreeing bins, and 0 at least.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import batch, mix, shingles, small_batches, staged, text_bytes

BINS = 256
BITS = 8
_SHIFT = np.uint64(56)  # the leading 8 bits name one of 256 bins
_EDGES = np.arange(BINS, dtype=np.uint64) << _SHIFT
_ATTEMPTS = 64


def _probes(first: int) -> np.ndarray:
    """Bins that each bin tries in attempts ``first`` and the following ones."""
    attempt = np.arange(first, first + _ATTEMPTS, dtype=np.uint64)[:, None]
    seed = np.arange(BINS, dtype=np.uint64)[None, :] * np.uint64(0x100000001B3) + attempt * np.uint64(0x9E3779B97F4A7C15)
    return (mix(seed + np.uint64(0x632BE59BD9B4E019)) >> _SHIFT).astype(np.int64)


_FIRST_PROBES = _probes(0)


def densify(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Give every empty bin the value of the first filled bin it tries."""
    out = values.copy()
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        probes = (_FIRST_PROBES if attempt == 0 else _probes(attempt))[:, empty]
        hit = filled[probes]
        found = hit.any(axis=0)
        at = probes[hit.argmax(axis=0), np.arange(len(empty))]
        out[empty[found]] = values[at[found]]
        empty = empty[~found]
        attempt += _ATTEMPTS
    return out


def fingerprint(tokens: np.ndarray) -> bytes:
    """Packed fingerprint of sorted distinct shingle hashes; empty without shingles."""
    if not len(tokens):
        return b""
    first = np.searchsorted(tokens, _EDGES)
    inside = np.minimum(first, len(tokens) - 1)
    filled = (first < len(tokens)) & ((tokens[inside] >> _SHIFT) == np.arange(BINS, dtype=np.uint64))
    values = densify(tokens[inside] & np.uint64(2**BITS - 1), filled)
    return values.astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of two fingerprints; two empty ones are alike."""
    if not a or not b:
        return float(a == b)
    agree = float(np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)))
    chance = 2.0**-BITS
    return max(0.0, (agree - chance) / (1.0 - chance))


_SCHEMA = pa.schema(
    [
        ("part", pa.int64()),
        ("kind", pa.string()),
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fp", pa.binary()),
        ("edited_fp", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("data", pa.binary()),
    ]
)
_DDL = (
    "part long, kind string, doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, "
    "near_edited double, near_next double, data binary"
)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _row(doc_id: int | None, data: bytes, fp: bytes, next_data: bytes, next_fp: bytes, words: int) -> tuple:
    text = data.decode()
    changed = edited(text, next_data.decode()).encode()
    changed_fp = fp if changed == data else fingerprint(shingles(changed, words))
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed).hexdigest(),
        fp,
        changed_fp,
        likeness(fp, changed_fp),
        likeness(fp, next_fp),
    )


def fingerprint_documents(docs: DataFrame, words: int = 5) -> DataFrame:
    """Fingerprints of each text and of its edited text, and likenesses to that and to the next document.

    Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``; fingerprints in base64. "Next" is by ascending ``doc_id`` (null first, equal ids by
    text hash), the first row after the last. A null text is empty. Texts are ranged by
    ``doc_id`` once; a task holds two neighbours at a time, and only the last text of each task
    meets the first of the following one afterwards.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        for incoming in batches:
            out = []
            for doc_id, data in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                fp = fingerprint(shingles(data, words))
                if held is None:
                    out.append((part, "head", doc_id, None, None, None, None, None, None, data))
                else:
                    out.append((part, "row", *_row(*held, data, fp, words), None))
                held = (doc_id, data, fp)
            yield batch(_SCHEMA, [*map(list, zip(*out))] if out else [[]] * len(_SCHEMA))
        if held is not None:
            yield batch(_SCHEMA, [[v] for v in (part, "tail", held[0], None, None, None, None, None, None, held[1])])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            for row in incoming.to_pylist():
                fp, next_fp = (fingerprint(shingles(row[c], words)) for c in ("data", "next_data"))
                values = (0, "row", *_row(row["doc_id"], row["data"], fp, row["next_data"], next_fp, words), None)
                yield batch(_SCHEMA, [[v] for v in values])

    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
        .withColumn("_h", F.xxhash64("data"))
        .repartitionByRange("doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "data")
    )
    done = staged(ranged.mapInArrow(run, _DDL), "fingerprints")
    # Which part follows which: one number per task.
    parts = sorted(r.part for r in done.filter("kind = 'head'").select("part").collect())
    spark = docs.sparkSession
    order = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next_part long")
    heads = done.filter("kind = 'head'").select(F.col("part").alias("next_part"), F.col("data").alias("next_data"))
    tails = done.filter("kind = 'tail'").select("part", "doc_id", "data")
    joined = tails.join(order, "part").join(heads, "next_part").select("doc_id", "data", "next_data")
    whole = done.filter("kind = 'row'").unionByName(joined.mapInArrow(ends, _DDL))
    return whole.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.translate(F.base64("fp"), "\r\n", "").alias("fingerprint"),
        F.translate(F.base64("edited_fp"), "\r\n", "").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
