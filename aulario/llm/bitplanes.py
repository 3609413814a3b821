"""Token-id files: fixed-size blocks of ids, transposed into planes, each compressed by itself.

A file holds the ids of consecutive documents in one stream. The stream is cut into blocks of
``block`` ids; a block of n ids is an n x 32 bit matrix, stored transposed: bit plane j is
bit j of every id (``planes="bit"``), byte plane j is byte j of every id (``planes="byte"``). Each
plane is compressed with zstandard; planes above the highest one used are left out. The footer
is the chunk index (offset, ids and plane sizes of every block) and the document index (id and
number of ids of every document), so a reader fetches any range of blocks by itself.

Layout: magic, planes of block 0, planes of block 1, ..., footer (zstandard), footer size
(8 bytes, little endian), magic.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulario.llm.common import batch, filesystem, small_batches, text_bytes
from aulario.llm.tokens import encoder

MAGIC = b"IDPLANE1"
END_ID = 0
BLOCK = 65_536
_NULL = np.iinfo(np.int64).min
_READ = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def to_planes(ids: np.ndarray, planes: str = "bit") -> list[bytes]:
    """Planes of a block, lowest first, without the empty ones at the top."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if planes == "byte":
        return [raw[:, j].tobytes() for j in range(-(-top // 8))]
    bits = np.unpackbits(raw[:, : -(-top // 8)], axis=1, bitorder="little")
    return [np.packbits(bits[:, j]).tobytes() for j in range(top)]


def from_planes(found: list[bytes], n: int, planes: str = "bit") -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    if planes == "byte":
        for j, plane in enumerate(found):
            raw[:, j] = np.frombuffer(plane, np.uint8)
    elif found:
        bits = np.zeros((n, -(-len(found) // 8) * 8), np.uint8)
        for j, plane in enumerate(found):
            bits[:, j] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n)
        raw[:, : bits.shape[1] // 8] = np.packbits(bits, axis=1, bitorder="little")
    return raw.view("<u4").ravel()


class PlaneWriter:
    """Writes one file; holds one block of ids and the indexes."""

    def __init__(self, out, planes: str = "bit", block: int = BLOCK, level: int = 3) -> None:
        self.out, self.planes, self.block = out, planes, block
        self.press = zstandard.ZstdCompressor(level=level)
        self.chunks: list = []
        self.docs: list[tuple[int, int]] = []
        self.pending: list[np.ndarray] = []
        self.held = 0
        self.n_ids = 0
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((_NULL if doc_id is None else doc_id, len(ids)))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.pending)
            whole = len(ids) // self.block * self.block
            for i in range(0, whole, self.block):
                self._chunk(ids[i : i + self.block])
            self.pending, self.held = [ids[whole:]], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        packed = [self.press.compress(p) for p in to_planes(ids, self.planes)]
        self.chunks.append([self.at, len(ids), [len(p) for p in packed]])
        for p in packed:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.held:
            self._chunk(np.concatenate(self.pending))
        head = json.dumps({"planes": self.planes, "chunks": self.chunks, "docs": len(self.docs)}).encode()
        table = np.array(self.docs, "<i8").reshape(-1, 2)
        footer = self.press.compress(
            len(head).to_bytes(8, "little") + head + table[:, 0].tobytes() + table[:, 1].tobytes()
        )
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()


class PlaneReader:
    """Reads a file's indexes, then any chunk."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0, io.SEEK_END)
        size = source.tell()
        source.seek(size - 8 - len(MAGIC))
        tail = source.read(8 + len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError("not a file of id planes, or cut short")
        length = int.from_bytes(tail[:8], "little")
        source.seek(size - 8 - len(MAGIC) - length)
        footer = zstandard.ZstdDecompressor().decompress(source.read(length))
        head = int.from_bytes(footer[:8], "little")
        index = json.loads(footer[8 : 8 + head])
        self.planes, self.chunks = index["planes"], index["chunks"]
        table = np.frombuffer(footer[8 + head :], "<i8").reshape(2, index["docs"])
        self.doc_ids, self.doc_lengths = table[0], table[1]

    def chunk(self, i: int) -> np.ndarray:
        at, n, sizes = self.chunks[i]
        self.source.seek(at)
        press = zstandard.ZstdDecompressor()
        return from_planes([press.decompress(self.source.read(s)) for s in sizes], n, self.planes)

    def documents(self) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
        """Each document's id and its ids as slices of chunks, to be read in order.

        One chunk is held at a time.
        """
        self._next, self._open, self._used = 0, np.zeros(0, np.uint32), 0
        for doc_id, length in zip(self.doc_ids.tolist(), self.doc_lengths.tolist()):
            yield (None if doc_id == _NULL else doc_id), self._slices(length)

    def _slices(self, length: int) -> Iterator[np.ndarray]:
        while length:
            if self._used == len(self._open):
                self._open, self._used = self.chunk(self._next), 0
                self._next += 1
            part = self._open[self._used : self._used + length]
            self._used += len(part)
            length -= len(part)
            yield part


def write_ids(
    docs: DataFrame, tokenizer_path: str, folder: str, planes: str = "bit", block: int = BLOCK
) -> list[tuple[str, int]]:
    """Encode ``docs`` (``doc_id``, ``text``) and write them in ascending ``doc_id`` order.

    Rows are ranged by ``doc_id`` (null first; equal ids by text hash), so every task writes one
    file and files follow each other in order. Returns (file, ids in it) of the files of
    successful tasks, in order: one entry per task. A lost executor's half-written file
    has a name of its own that no list mentions. A null or empty text is the end id alone.
    """
    small_batches(docs.sparkSession)
    system, root = filesystem(folder)
    system.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, words=False).encode_many
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], np.uint32)
        system, root = filesystem(folder)
        name, writer = f"ids-{part:06d}-{uuid.uuid4().hex}.bin", None
        for incoming in batches:
            for doc_id, ids in zip(incoming.column(0).to_pylist(), encode(incoming.column(1).to_pylist())):
                if writer is None:
                    writer = PlaneWriter(system.open_output_stream(f"{root}/{name}"), planes, block)
                writer.add(doc_id, np.append(ids, end))
        if writer is not None:
            writer.close()
            schema = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_ids", pa.int64())])
            yield batch(schema, [[part], [name], [writer.n_ids]])

    ranged = (
        docs.select("doc_id", text_bytes().alias("text"))
        .withColumn("_h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "text")
    )
    done = ranged.mapInArrow(run, "part long, file string, n_ids long").collect()
    return [(r.file, r.n_ids) for r in sorted(done, key=lambda r: r.part)]


def read_ids(spark: SparkSession, folder: str, files: list[tuple[str, int]]) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``, from the stored planes."""
    rows, start = [], 0
    for name, n_ids in files:
        rows.append((name, start))
        start += n_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        for incoming in batches:
            for name, start in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                with system.open_input_file(f"{root}/{name}") as source:
                    out: list[tuple] = []
                    for doc_id, slices in PlaneReader(source).documents():
                        crc, n = 0, 0
                        for part in slices:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            n += len(part)
                        out.append((doc_id, start, n, crc))
                        start += n
                        if len(out) == 10_000:
                            yield batch(_READ, [*map(list, zip(*out))])
                            out = []
                    if out:
                        yield batch(_READ, [*map(list, zip(*out))])

    listed = spark.createDataFrame(rows, "file string, start long").repartition(max(1, len(rows)))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
