"""Removal of repeated byte strings, by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a
smaller ``doc_id``, or earlier in the same document. The suffixes that matter are put in buckets
that are refined level by level, down to ``length`` bytes, and a bucket leaves as soon as it is settled.

* Initial buckets are q-grams. Of the q-grams in a window of ``length`` bytes the one with the smallest
  hash (leftmost among equals) stands for the window, so equal windows are in one bucket; neighbouring
  windows mostly share it and form a run. A bucket that occurs once in the corpus is settled.
* First refinement: a run's identifier, made of all its bytes. A run that a smaller ``doc_id``
  also has is repeated as a whole. Buckets with one identifier are settled.
* Second refinement, in buckets where runs differ (around edits and the ends of passages): each window
  gets the pair of q-gram bucket identifiers at its start and q bytes later, then the pair of those
  and the ones 2q later. These identifiers are reused at every offset of the run, and sorting
  on them tells the earliest document of each window. Buckets of at most ``LARGE`` runs, which is
  nearly all, are sorted by bucket and document and refined in one sweep over the runs' bytes,
  without a row per window.

Texts are scanned for the counts, for the runs and for the cuts. In between a run travels with its place in
the text, so its bytes are found without a scan, and a run that an earlier ``doc_id`` has is cut by its place.

Other buckets are exchanged as identifiers with a minimum of ``doc_id``, never as lists of their
members, so a passage that a third of all documents hold is a partial minimum per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.llm.common import batch, drop_memos, mix, small_batches, staged, text_bytes

# Runs of a bucket that one task refines together; larger buckets are refined by window.
LARGE = 4096

_LAST = np.iinfo(np.int64).max  # stands for a null doc_id: after all others
_GROUP = 1 << 17  # bytes scanned or refined together, whose arrays fit a core's cache
_POSITION = np.uint64((1 << 21) - 1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_U = np.uint64


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n - 1, base)], dtype=np.uint64)


_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_SIZE = _GROUP + 4096
_UP, _DOWN = _powers(_BASE, _SIZE), _powers(_INVERSE, _SIZE)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of two identifiers in order."""
    return mix(a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(29))))


def _grams(data: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the bytes' values and an identifier per q-gram, of less than ``_SIZE`` bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _DOWN[:n], out=sums[1:])
    return sums, mix((sums[q:] - sums[: n + 1 - q]) * _UP[: n + 1 - q]) if n >= q else np.zeros(0, _U)


def _identifiers(grams: np.ndarray, starts: np.ndarray, length: int, q: int) -> np.ndarray:
    """Identifiers of the strings of ``length`` bytes at some starts, from those of their q-grams.

    Pairs of identifiers at later offsets: q, 2q, 4q, ... bytes deep, then up to the length.
    """

    def at(offset: int, level: int) -> np.ndarray:
        if level == q:
            return grams[starts + offset]
        return pair(at(offset, level // 2), at(offset + level // 2, level // 2))

    level = q
    while 2 * level <= length:
        level *= 2
    ids = at(0, level)
    # The last identifier overlaps what is covered.
    return pair(ids, at(length - level, level)) if length > level else ids


class Scan:
    """Runs of the windows of some pieces of text (together below the group size)."""

    def __init__(self, pieces: list[bytes], length: int, q: int) -> None:
        self.length, self.q = length, q
        sizes = np.array([len(p) for p in pieces])
        self.ends = np.cumsum(sizes)
        self.sums, self.grams = _grams(np.frombuffer(b"".join(pieces), np.uint8), q)
        empty = np.zeros(0, np.int64)
        self.piece = self.first = self.last = empty
        self.gram = self.run = np.zeros(0, np.uint64)
        keys = self.grams & ~_POSITION
        keys |= np.arange(len(keys), dtype=np.uint64)
        lows = self._sliding(keys, length - q + 1)
        whole = sizes >= length
        if not whole.any():
            return
        # A run ends where the smallest q-gram changes and where windows no longer fit the piece.
        change = np.zeros(len(lows) + 1, bool)
        change[1:-1] = lows[1:] != lows[:-1]
        change[(self.ends - sizes)[whole]] = True
        change[self.ends[whole] - length + 1] = True
        bounds = np.flatnonzero(change)
        bounds = bounds if bounds[-1] == len(lows) else np.r_[bounds, len(lows)]
        starts, stops = bounds[:-1], bounds[1:] - 1
        piece = np.searchsorted(self.ends, starts, side="right")
        keep = starts + length <= self.ends[piece]
        self.first, self.last, self.piece = starts[keep], stops[keep], piece[keep]
        anchor = (lows[self.first] & _POSITION).astype(np.int64)
        self.gram = self.grams[anchor]
        content = (self.sums[self.last + length] - self.sums[self.first]) * _UP[self.first]
        shape = ((self.last - self.first) * 1024 + (anchor - self.first)).astype(np.uint64)
        self.run = pair(mix(content), shape)

    @staticmethod
    def _sliding(keys: np.ndarray, span: int) -> np.ndarray:
        """Minimum of every ``span`` neighbours, from minima of 2, 4, 8, ... of them."""
        low, width = keys, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[: width - span], low[span - width :]) if width < span else low

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(run index, start, bucket, identifier) of all windows of some runs."""
        counts = self.last[runs] - self.first[runs] + 1
        number = np.repeat(runs, counts)
        starts = np.repeat(self.first[runs] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return number, starts, self.gram[number], _identifiers(self.grams, starts, self.length, self.q)


def groups(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces (row, offset, bytes) of texts in groups; long texts are cut with overlaps."""
    waiting: list[tuple[int, int, bytes]] = []
    held = 0
    step = _GROUP - length
    for row, data in enumerate(texts):
        for offset in range(0, max(len(data) - length + 1, 1), step):
            part = data[offset : offset + step + length - 1]
            if held + len(part) > _GROUP and waiting:
                yield waiting
                waiting, held = [], 0
            waiting.append((row, offset, part))
            held += len(part)
    if waiting:
        yield waiting


def scans(texts: list[bytes], length: int, q: int) -> Iterator[tuple[Scan, np.ndarray, np.ndarray]]:
    """Scans of texts, with the row of each run and what its positions lack to positions in the text."""
    for group in groups(texts, length):
        scan = Scan([p for _, _, p in group], length, q)
        rows = np.array([r for r, _, _ in group], np.int64)
        begins = np.r_[0, scan.ends[:-1]]
        shifts = np.array([o for _, o, _ in group], np.int64) - begins
        yield scan, rows[scan.piece], shifts[scan.piece]


def _of_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return pair(values, rows.astype(np.uint64) + _U(1))


def _flat(lists: pa.Array | list[list | None]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a list per row."""
    if not isinstance(lists, pa.Array):
        lists = pa.array(lists, pa.list_(pa.int64()))
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), counts), lists.flatten().to_numpy(zero_copy_only=False)


def _listed(lists: pa.Array | list[list | None]) -> np.ndarray:
    """Identifiers of (row, run) for a list of runs per row."""
    rows, runs = _flat(lists)
    return _of_row(runs.view(np.uint64), rows)


# A place in a text (``at``): the start of a first window, times the length, and how many windows follow it.
_RUNS = pa.schema([("g", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int64())])
_CONTENT = pa.schema(
    [("g", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int64()), ("content", pa.binary())]
)
_HITS = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int64())])
_WINDOWS = pa.schema(
    [("g", pa.int64()), ("h", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int64())]
)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with their place in the order (``doc``), what tells rows of one ``doc`` apart (``th``), text and other columns.

    Also, whether every row has a ``doc_id`` of its own, as usual; then ``th`` is 0 and costs no room.
    """
    data = text_bytes()
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"))
    unique = ids.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty()
    others = [c for c in docs.columns if c != "text"]
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
        (F.lit(0).cast("long") if unique else F.xxhash64(data)).alias("th"),
        data.alias("data"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
    )
    return keyed, unique


def _packed(keyed: DataFrame) -> DataFrame:
    """The rows with their texts compressed, to be exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos()
        press = zstandard.ZstdCompressor(level=3)
        for incoming in batches:
            doc, th, data, row = (incoming.column(i) for i in range(4))
            z = pa.array([press.compress(d) for d in data.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([doc, th, z, row], names=["doc", "th", "z", "row"])

    fields = [("doc", T.LongType()), ("th", T.LongType()), ("z", T.BinaryType()), ("row", keyed.schema["row"].dataType)]
    return keyed.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def _unpack(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(z) for z in column.to_pylist()]


def _first_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first entry with each key, in the order of keys, and for every entry that of the first one like it."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(key)
    ordered = key[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    firsts = np.minimum.reduceat(order, begins)
    like = np.empty(len(key), np.int64)
    like[order] = np.repeat(firsts, np.diff(np.r_[begins, len(key)]))
    return firsts, like


def _distinct_runs(scan: Scan, rows: np.ndarray) -> np.ndarray:
    """Indexes of the first run of each (row, run)."""
    return np.sort(_first_of(_of_row(scan.run, rows))[0])


def _emit_runs(docs: DataFrame, length: int, q: int, only_bucket: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            doc = incoming.column(0).to_numpy(zero_copy_only=False)
            th = incoming.column(1).to_numpy(zero_copy_only=False)
            for scan, rows, shifts in scans(incoming.column(2).to_pylist(), length, q):
                keep = _distinct_runs(scan, rows)
                if not len(keep):
                    continue
                g = _signed(scan.gram[keep])
                if only_bucket:
                    yield batch(pa.schema([("g", pa.int64())]), [g])
                else:
                    at = (scan.first[keep] + shifts[keep]) * length + scan.last[keep] - scan.first[keep]
                    yield batch(_RUNS, [g, _signed(scan.run[keep]), doc[rows[keep]], th[rows[keep]], at])

    schema = "g long" if only_bucket else "g long, run long, doc long, th long, at long"
    return docs.select("doc", "th", "data").mapInArrow(run, schema)


def _emit_windows(joined: DataFrame, length: int, q: int) -> DataFrame:
    """First occurrence in its row of every window of the runs listed in ``wide``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            doc = incoming.column(0).to_numpy(zero_copy_only=False)
            th = incoming.column(1).to_numpy(zero_copy_only=False)
            rows, g, h, at = _windows(_unpack(incoming.column(2)), _listed(incoming.column(3)), length, q)
            first = ~_seen_before(at, rows, g, h)
            if first.any():
                r = rows[first]
                yield batch(_WINDOWS, [_signed(g[first]), _signed(h[first]), doc[r], th[r], at[first]])

    return joined.select("doc", "th", "z", "wide").mapInArrow(run, "g long, h long, doc long, th long, at long")


def _windows(texts: list[bytes], keys: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    """(row, bucket, identifier, start) of the windows of the runs with some identifiers of (row, run)."""
    parts = []
    for scan, rows, shifts in scans(texts, length, q) if len(keys) else ():
        runs = np.flatnonzero(np.isin(_of_row(scan.run, rows), keys))
        if len(runs):
            number, starts, g, h = scan.windows(runs)
            parts.append((rows[number], g, h, starts + shifts[number]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _seen_before(at: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Flags of entries whose keys also stand at a smaller position."""
    order = np.lexsort((at, *keys))
    same = np.ones(max(len(at) - 1, 0), bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    out = np.zeros(len(at), bool)
    out[order[1:]] = same
    return out


def _open_runs(joined: DataFrame, length: int) -> DataFrame:
    """Bytes of the runs listed in ``open``: ``g, doc, th, at, content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            doc = incoming.column(0).to_numpy(zero_copy_only=False)
            th = incoming.column(1).to_numpy(zero_copy_only=False)
            texts = _unpack(incoming.column(2))
            rows, g = _flat(incoming.column(3))
            _, at = _flat(incoming.column(4))
            first, more = np.divmod(at, length)
            content = [texts[i][a:b] for i, a, b in zip(rows.tolist(), first.tolist(), (first + more + length).tolist())]
            yield batch(_CONTENT, [g, doc[rows], th[rows], at, content])

    columns = joined.select("doc", "th", "z", F.col("open.g").alias("g"), F.col("open.at").alias("at"))
    return columns.mapInArrow(run, "g long, doc long, th long, at long, content binary")


class Sweep:
    """Refinement of runs that come by bucket and ``doc``; a bucket may go on from one call to the next."""

    def __init__(self, length: int, q: int) -> None:
        self.length, self.q = length, q
        # Of the last bucket: its identifier, those of its windows and the ``doc`` that had each first.
        self.bucket, self.known, self.docs = None, np.zeros(0, _U), np.zeros(0, np.int64)

    def late(self, g: np.ndarray, doc: np.ndarray, content: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches of windows that a smaller ``doc`` of the bucket has: run, first and last window."""
        sizes = np.array([len(c) for c in content])
        counts = sizes - self.length + 1
        run = np.repeat(np.arange(len(content)), counts)
        begins = np.cumsum(counts) - counts
        offset = np.arange(len(run)) - begins[run]
        grams = _grams(np.frombuffer(b"".join(content), np.uint8), self.q)[1]
        ids = _identifiers(grams, (np.cumsum(sizes) - sizes)[run] + offset, self.length, self.q)
        # What is known of the bucket that goes on stands before its new windows.
        before = len(self.known) if self.bucket == g[0] else 0
        number = np.cumsum(np.r_[False, g[1:] != g[:-1]])
        numbers = np.r_[np.zeros(before, np.int64), number[run]]
        ids, docs = np.r_[self.known[:before], ids], np.r_[self.docs[:before], doc[run]]
        firsts, like = _first_of(_of_row(ids, numbers))
        last = firsts[numbers[firsts] == number[-1]]
        self.bucket, self.known, self.docs = g[-1], ids[last], docs[last]
        gone = (docs > docs[like])[before:]
        edge = np.r_[True, (run[1:] != run[:-1])]
        opens = np.flatnonzero(gone & (edge | ~np.r_[False, gone[:-1]]))
        ends = np.flatnonzero(gone & (np.r_[edge[1:], True] | ~np.r_[gone[1:], False]))
        return run[opens], offset[opens], offset[ends]


def _refine(runs: DataFrame, length: int, q: int) -> DataFrame:
    """Windows of open runs that a smaller ``doc`` of the bucket also has: ``doc, th, at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep(length, q)
        for held in _gathered(batches):
            g, doc, th, at = (held.column(i).to_numpy() for i in range(4))
            number, lo, hi = sweep.late(g, doc, held.column(4).to_pylist())
            if len(number):
                start = at[number] // length + lo
                yield batch(_HITS, [doc[number], th[number], start * length + hi - lo])

    ordered = runs.repartition("g").sortWithinPartitions("g", "doc", "th", "at")
    return ordered.select("g", "doc", "th", "at", "content").mapInArrow(run, "doc long, th long, at long")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together, or cut, to less than ``_GROUP`` bytes of runs, which differ in size by less than half."""
    held: list[pa.RecordBatch] = []
    size = 0
    for incoming in batches:
        rows = max(incoming.num_rows * _GROUP // 2 // max(incoming.nbytes, 1), 1)
        for a in range(0, incoming.num_rows, rows):
            part = incoming.slice(a, rows)
            if held and size + part.nbytes > _GROUP:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held)


def repeated(
    texts: list[bytes], dup: pa.Array | list, opened: pa.Array | list, hits: pa.Array | list, length: int, q: int
) -> list[np.ndarray]:
    """Per text, flags of the bytes that repeat an earlier string.

    ``dup`` and ``hits`` list places that repeat another document, ``opened`` the runs whose bucket holds different ones.
    """
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    marks = np.zeros(begins[-1], np.int32)  # +1 where a repeated stretch begins, -1 behind its end

    def mark(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(marks, begins[rows] + first, 1)
        np.add.at(marks, begins[rows] + last + length, -1)

    for places in (dup, hits):
        rows, at = _flat(places)
        mark(rows, at // length, at // length + at % length)
    found = [(r, s.run, s.gram, s.first + shifts, s.last + shifts) for s, r, shifts in scans(texts, length, q)]
    if found:
        rows, runs, grams, first, last = (np.concatenate(x) for x in zip(*found))
        keys = _of_row(runs, rows)
        gone = _first_of(keys)[1] != np.arange(len(keys))
        mark(rows[gone], first[gone], last[gone])
        # Different runs of a bucket within a text: only they can share windows, and only such texts are scanned again.
        distinct = np.flatnonzero(~gone)
        like = _first_of(_of_row(grams[distinct], rows[distinct]))[1]
        several = distinct[np.bincount(like, minlength=len(like))[like] > 1]
        several = several[np.isin(keys[several], _listed(opened))]
        some = set(rows[several].tolist())
        row, g, h, at = _windows([t if i in some else b"" for i, t in enumerate(texts)], keys[several], length, q)
        late = _seen_before(at, row, g, h)
        mark(row[late], at[late], at[late])
    covered = np.cumsum(marks, dtype=np.int32) > 0
    return [covered[a : a + len(t)] for a, t in zip(begins.tolist(), texts)]


def remove_repeats(docs: DataFrame, length: int = 100, q: int = 25, large: int = LARGE) -> DataFrame:
    """Per row of ``docs``: ``row`` (its columns but the text), ``n_bytes, n_removed, n_spans, kept_sha256, kept`` (bytes).

    Strings are judged on the input; spans are maximal removed runs. A null text is empty. Rows with
    one ``doc_id`` do not count as earlier than each other; rows without one come after all
    others. Column names do not matter, since a row travels as one value.
    """
    small_batches(docs.sparkSession)
    keyed, unique = _keyed(docs)
    shared = _emit_runs(keyed, length, q, True).groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g")
    runs = staged(_emit_runs(keyed, length, q, False).join(shared, "g", "left_semi"), "runs")
    firsts = staged(
        runs.groupBy("g", "run").agg(F.min("doc").alias("first"), F.max("doc").alias("latest")), "firsts"
    )
    mixed = firsts.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    firsts = firsts.join(mixed, "g", "left").filter("first < latest or kinds > 1")
    flagged = runs.join(firsts, ["g", "run"])
    later = F.col("doc") > F.col("first")
    small = F.col("kinds") <= large
    marked = flagged.filter(later | F.col("kinds").isNotNull())
    texts = _packed(keyed.withColumn("row", F.struct(F.lit(0))))
    if not unique:  # equal rows have equal runs: once is enough
        marked, texts = marked.dropDuplicates(["doc", "th", "run"]), texts.dropDuplicates(["doc", "th"])
    lists = staged(
        marked.groupBy("doc", "th").agg(
            F.collect_list(F.when(later, F.col("at"))).alias("dup"),
            F.collect_list(F.when(~later & small, F.struct("g", "run", "at"))).alias("open"),
            F.collect_list(F.when(~later & ~small, F.col("run"))).alias("wide"),
        ),
        "lists",
    )
    opened = texts.join(
        lists.filter((F.size("open") > 0) | (F.size("wide") > 0)).select("doc", "th", "open", "wide"), ["doc", "th"]
    )
    hits = _refine(_open_runs(opened.filter(F.size("open") > 0), length), length, q)
    if not lists.filter(F.size("wide") > 0).isEmpty():
        hits = hits.unionByName(_late_windows(opened.filter(F.size("wide") > 0), length, q))
    hits = staged(hits.groupBy("doc", "th").agg(F.collect_list("at").alias("hits")), "hits")
    marks = lists.withColumn("open", F.concat("open.run", "wide")).drop("wide").join(hits, ["doc", "th"], "left")
    return _cut(_packed(keyed).join(marks, ["doc", "th"], "left"), length, q)


def _late_windows(opened: DataFrame, length: int, q: int) -> DataFrame:
    """Windows of the runs of large buckets that a smaller ``doc`` also has, by the window's identifier."""
    windows = staged(_emit_windows(opened, length, q), "windows")
    earliest = windows.groupBy("g", "h").agg(F.min("doc").alias("first"), F.max("doc").alias("latest")).filter("first < latest")
    late = windows.join(earliest, ["g", "h"]).filter("doc > first")
    return late.select("doc", "th", (F.col("at") * length).alias("at"))


def _cut(joined: DataFrame, length: int, q: int) -> DataFrame:
    fields = [
        T.StructField("row", joined.schema["row"].dataType),
        *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept", T.BinaryType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            row, data, dup, opened, hits = (incoming.column(i) for i in range(5))
            out: list[list] = [[], [], [], [], []]
            texts = _unpack(data)
            flags = repeated(texts, dup, opened, hits, length, q)
            for text, gone in zip(texts, flags):
                kept, spans = text, 0
                if gone.any():
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                for column, value in zip(out, (len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [row, *[pa.array(c, t) for c, t in zip(out, types)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return joined.select("row", "z", "dup", "open", "hits").mapInArrow(run, T.StructType(fields))
