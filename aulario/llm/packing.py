"""Packing of token sequences by multiway differencing.

Every task encodes the documents of its own split, cuts them, and packs the cuts; nothing is
shuffled. A document of at least ``capacity`` ids gives whole sequences of its own; what is left
of it, and every shorter document, is cut into near-equal pieces of at most ``piece`` ids. Pieces
are collected until they fill ``group`` sequences, and each such group is packed on its own, so
memory stays bounded and the padding of a group is about half a sequence at most plus the
remaining imbalance.

A group is packed by Karmarkar-Karp differencing into k windows: each piece starts as a partial
partition with one filled window; the two partial partitions with the largest spread (fullest
less emptiest window) are merged over and over, the fullest windows of one with the emptiest
of the other. If the fullest window exceeds the capacity, k rises and the group is packed anew.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from aulario.llm.common import batch, drop_memos, small_batches, text_bytes
from aulario.llm.tokens import encoder

END_ID = 1
# Pieces that the encoder remembers: a stage among others leaves them room in the worker.
_PIECES = 150_000
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def differencing(lengths: np.ndarray, k: int) -> np.ndarray:
    """Window (0..k-1) of each item, by Karmarkar-Karp differencing into k windows."""
    n = len(lengths)
    if k == 1 or n == 1:
        return np.zeros(n, np.int64)
    sums: list[np.ndarray | None] = []
    heap = []
    for i, length in enumerate(lengths):
        leaf = np.zeros(k, np.int64)
        leaf[0] = length
        sums.append(leaf)
        heap.append((-int(length), i))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        sums[a] = sums[b] = None
        sums.append(total)
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(total[0]), n + len(merges) - 1))
    windows: dict[int, np.ndarray] = {n + len(merges) - 1: np.arange(k)}
    out = np.zeros(n, np.int64)
    for i in range(len(merges) - 1, -1, -1):
        a, b, order = merges[i]
        now = windows.pop(n + i)
        before = np.empty(k, np.int64)
        before[order] = now
        for child, at in ((a, before), (b, before[::-1])):
            if child < n:
                out[child] = at[0]
            else:
                windows[child] = at
    return out


def pack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item such that no window holds more than ``capacity``."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        windows = differencing(lengths, k)
        if np.bincount(windows, weights=lengths, minlength=k).max() <= capacity:
            return windows
        k += max(1, k // 128)


def cuts(total: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids."""
    whole = total // capacity
    out = [(i * capacity, capacity) for i in range(whole)]
    start = whole * capacity
    rest = total - start
    if rest:
        parts = -(-rest // piece)
        edges = [start + rest * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    piece: int = 512,
    group: int = 128,
) -> DataFrame:
    """Encode documents (``doc_id``, ``text``) and pack them into sequences of ``capacity`` ids.

    Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Every
    document ends with id 1, so a null or empty text is one piece of one id. Documents with a
    null or repeated ``doc_id`` are packed like any other; an empty table gives no rows; other
    columns are not read. Sequence ids are unique, not consecutive.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos(keep="encoders")
        encode = encoder(tokenizer_path, words=True, pieces=_PIECES).encode_many
        end = np.array([END_ID], np.uint32)
        task = TaskContext.get().partitionId() << 33
        made = 0
        waiting: list[tuple] = []
        held = 0

        def packed() -> pa.RecordBatch:
            nonlocal made, waiting, held
            lengths = np.array([w[2] for w in waiting])
            windows = pack(lengths, capacity)
            order = np.argsort(windows, kind="stable")
            windows, lengths = windows[order], lengths[order]
            before = np.cumsum(lengths) - lengths
            first = np.r_[True, windows[1:] != windows[:-1]]
            number = np.cumsum(first) - 1
            offsets = before - before[first][number]
            rows = [waiting[i] for i in order]
            out = batch(_SCHEMA, [*map(list, zip(*rows)), task + made + number, offsets])
            made += int(number[-1]) + 1
            waiting, held = [], 0
            return out

        for incoming in batches:
            full = []
            for doc_id, ids in zip(incoming.column(0).to_pylist(), encode(incoming.column(1).to_pylist())):
                total = len(ids) + 1
                ids = np.append(ids, end).astype("<u4").tobytes()
                for start, length in cuts(total, capacity, piece):
                    row = (doc_id, start, length, zlib.crc32(ids[start * 4 : (start + length) * 4]), total)
                    if length == capacity:
                        full.append((*row, task + made, 0))
                        made += 1
                    else:
                        waiting.append(row)
                        held += length
                        if held >= group * capacity:
                            yield packed()
            if full:
                yield batch(_SCHEMA, [*map(list, zip(*full))])
        if waiting:
            yield packed()

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
