"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text's segmentation is a path of pieces with the largest sum of scores. Of equal sums the one whose
last piece is longest, then the one before it, and so on, which is what the library's own unigram
segmentation takes. A text of up to ``chunk`` characters is segmented by itself. A longer one is cut into
chunks, whatever stands there, and each chunk is worked on by itself:

1. A chunk's transfer matrix has the best score from every entry state to every exit state; a
   state is how far the piece that crosses a boundary reaches beyond it, 0 to the longest piece.
   Beside it stands the order in which equal sums into an exit state are taken. Combining two chunks
   is the max-plus matrix product that carries both, which is associative, so products are
   taken in a tree of ``FAN`` children a node, with no more than that many matrices in one row.
2. A text begins and ends in state 0. Down the tree, the states between a node's children follow
   from its own entry and exit state.
3. With both its states known, each chunk is traced back independently into ids.

The ids of a text are the same for every chunk size (scores that are whole numbers; others up to rounding of
their sums). The vocabulary is a SentencePiece model file. Its pieces and scores are taken as they are, so this is the
segmentation of a unigram model with that vocabulary; characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulario.llm.common import MEMORIES, batch, drop_memos, new_folder, small_batches, staged

SPACE = "▁"
CHUNK = 4096
FAN = 64
# Words remembered per worker, and their characters in all.
MEMO_UNITS = 300_000
MEMO_CHARS = 8_000_000
_UNKNOWN_PENALTY = 10.0
# Scores below this (pieces that only stand for themselves) count as this, so that sums stay exact.
FLOOR = -100_000.0
# Words up to this length have sums that 32-bit numbers hold exactly (160 * 100,010 < 2^24).
_EXACT = 160
_NEG = -np.inf
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_PARTING = re.compile(f"(?<=[^{SPACE}]){SPACE}")
_ENCODED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DDL = "doc_id long, key long, chunk long, ids array<int>"


class _Units(dict):
    """Word -> number; unknown words get the next number and are noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Vocabulary:
    """Pieces of a model file and the best paths through strings."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as formats

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes = [0] * 256
        lowest = 0.0
        size = m.get_piece_size()
        self.scores = np.zeros(size)
        self.surface = [m.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for i in range(size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.surface[i] = bytes([value])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                score = max(m.get_score(i), FLOOR)
                self.pieces[piece] = (score, i)
                self.scores[i] = score
                lowest = min(lowest, score)
        self.unknown = lowest - _UNKNOWN_PENALTY
        # A character without a piece counts once, with the first of its bytes.
        for value, i in enumerate(self.bytes):
            self.scores[i] = self.unknown if value & 0xC0 != 0x80 else 0.0
        self.longest = max(map(len, self.pieces))
        # Whether no piece goes on from another character into a space, so that words part.
        self.words_part = not any(b == SPACE and a != SPACE for p in self.pieces for a, b in zip(p, p[1:]))
        proto = formats.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        self.plain = not (spec.precompiled_charsmap or spec.remove_extra_whitespaces) and spec.add_dummy_prefix and spec.escape_whitespaces
        self.plain = self.plain and not proto.trainer_spec.treat_whitespace_as_suffix
        self.library = None
        if all(score == int(score) for score, _ in self.pieces.values()):
            # The same pieces and scores as a unigram model that takes normalised words as they are.
            for piece in proto.pieces:
                if piece.piece in self.pieces:
                    piece.type, piece.score = piece.NORMAL, max(piece.score, FLOOR)
            proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
            spec.precompiled_charsmap = b""
            spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
            self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self._empty()

    def _empty(self) -> None:
        self.memo = _Units()
        self.memo_chars = 0
        self.starts, self.counts, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.known = np.zeros(1 << 16, np.int32)
        self.used = 0

    def normalize(self, text: str) -> str:
        if self.plain:
            return SPACE + text.replace(" ", SPACE) if text else ""
        return self.model.normalize(text)

    def matches(self, s: str, i: int, end: int) -> Iterator[tuple[int, float, int]]:
        """(next position, score, id) of the pieces at i; id -1 for a character without one."""
        single = False
        for j in range(i + 1, min(i + self.longest, end) + 1):
            found = self.pieces.get(s[i:j])
            if found is not None:
                single = single or j == i + 1
                yield j, found[0], found[1]
        if not single:
            yield i + 1, self.unknown, -1

    def path(self, s: str, start: int, end: int, shut: int | None = None) -> list[int]:
        """Ids of the best path from ``start`` to ``end``; no break at ``shut`` or behind it but the end."""
        n = end - start
        best = [_NEG] * (n + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        best[0] = 0.0
        open_to = n if shut is None else min(n, shut - start)
        for i in range(open_to):
            if best[i] == _NEG:
                continue
            for j, score, piece in self.matches(s, start + i, end):
                at = j - start
                if open_to <= at < n:
                    continue
                if best[i] + score > best[at]:
                    best[at] = best[i] + score
                    back[at] = (i, piece)
        ids: list[int] = []
        i = n
        while i:
            before, piece = back[i]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.bytes[b] for b in reversed(s[start + before].encode())]
            i = before
        return ids[::-1]

    def _learn(self) -> None:
        """Segment the words that the memo has numbered but not seen."""
        new, self.memo.new = self.memo.new, []
        ids: list = [None] * len(new)
        short = [i for i, unit in enumerate(new) if self.library is not None and len(unit) <= _EXACT]
        if short:
            for i, found in zip(short, self.library.encode([new[i] for i in short], num_threads=1)):
                ids[i] = found
        for i, unit in enumerate(new):
            if ids[i] is None:
                ids[i] = self.path(unit, 0, len(unit))
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for found in ids for i in found), np.int32, int(counts.sum()))
        ends = np.cumsum(counts)
        while self.used + len(flat) > len(self.known):
            self.known = np.r_[self.known, np.zeros_like(self.known)]
        self.known[self.used : self.used + len(flat)] = flat
        total = np.r_[0.0, np.cumsum(self.scores[flat])]
        self.starts = np.r_[self.starts, self.used + ends - counts]
        self.counts = np.r_[self.counts, counts]
        self.sums = np.r_[self.sums, total[ends] - total[ends - counts]]
        self.used += len(flat)
        self.memo_chars += sum(map(len, new))

    def encode_all(self, strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of normalised strings one after another, how many each has, and each one's sum of scores."""
        if len(self.memo) > MEMO_UNITS or self.memo_chars > MEMO_CHARS:
            self._empty()
        units: list[str] = []
        sizes = np.zeros(len(strings), np.int64)
        for k, s in enumerate(strings):
            found = _UNITS.findall(s) if self.words_part else [s] if s else []
            sizes[k] = len(found)
            units += found
        numbers = np.fromiter(map(self.memo.__getitem__, units), np.int64, len(units))
        if self.memo.new:
            self._learn()
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        ids = self.known[np.arange(int(counts.sum())) + np.repeat(self.starts[numbers] - ends + counts, counts)]
        last = np.cumsum(sizes)
        tokens, sums = np.r_[0, ends], np.r_[0.0, np.cumsum(self.sums[numbers])]
        return ids, tokens[last] - tokens[last - sizes], sums[last] - sums[last - sizes]

    def encode(self, s: str) -> tuple[float, list[int]]:
        """Sum of scores and ids of a normalised string."""
        ids, _, sums = self.encode_all([s])
        return float(sums[0]), ids.tolist()

    def decode(self, ids: Sequence[int], first: bool = True) -> str:
        """Text of ids; the space that normalising put before a text is taken away again."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if first and text.startswith(" ") else text

    def parting(self, s: str, length: int) -> tuple[int, int] | None:
        """First and last place between words in (longest, length], which every path passes."""
        found = _PARTING.search(s, self.longest + 1, length + 1) if self.words_part else None
        if found is None:
            return None
        last = s.rfind(SPACE, found.start(), length + 1)
        while last > found.start() and s[last - 1] == SPACE:
            last -= 1
        return found.start(), last

    def trace(self, s: str, length: int, entry: int, exit_: int) -> tuple[list[int], str, list[int]]:
        """Ids of a chunk between two states: those before its whole words, these words, those behind them."""
        parts = self.parting(s, length)
        if parts is None:
            return self.path(s, entry, length + exit_, length), "", []
        meet, at = parts
        return self.path(s, entry, meet), s[meet:at], self.path(s, at, length + exit_, length)

    def _from_states(self, s: str, edges: list, stop: int, goals: range) -> tuple[np.ndarray, np.ndarray]:
        """Best sums from every entry state to every goal (``stop`` or behind it), and the order of the entries.

        Paths into a goal are ordered by their breaks from the end: the one that breaks earlier comes first.
        """
        w = self.longest
        sums, ranks = np.full((w, len(goals)), _NEG), np.zeros((w, len(goals)))
        breaks: list[list[tuple]] = [[] for _ in goals]
        for entry in range(min(w, stop + 1)):
            best = [_NEG] * (goals[-1] + 1)
            back = [-1] * (goals[-1] + 1)
            best[entry] = 0.0
            for i in range(entry, stop):
                base = best[i]
                if base != _NEG:
                    for j, score, _ in edges[i]:
                        if j <= goals[-1] and base + score > best[j]:
                            best[j], back[j] = base + score, i
            for k, goal in enumerate(goals):
                sums[entry, k] = best[goal]
                if best[goal] != _NEG:
                    way, i = [], back[goal]
                    while i != -1:
                        way.append(i)
                        i = back[i]
                    breaks[k].append((way, entry))
        for k, found in enumerate(breaks):
            for rank, (_, entry) in enumerate(sorted(found)):
                ranks[entry, k] = rank
        return sums, ranks

    def transfer(self, s: str, length: int, middle: float | None = None) -> np.ndarray:
        """Matrix of a chunk: ``s`` is its ``length`` characters and what a piece may reach beyond.

        Where all paths share a place the matrix is a sum of two vectors, and is given as three rows: sums from
        the entries, their order, sums to the exits. Else it is w rows of sums, then w of orders.
        ``middle`` is the sum over the whole words within the chunk, where it is known.
        """
        w = self.longest
        parts = self.parting(s, length)
        if parts is None:
            edges = [list(self.matches(s, i, len(s))) for i in range(length)]
            reach = np.maximum.accumulate([max(j for j, _, _ in found) for found in edges])
            shared = [p for p in range(w + 1, length + 1) if reach[p - 1] <= p]
            if not shared:
                return np.concatenate(self._from_states(s, edges, length, range(length, length + w)))
            meet, at = shared[0], shared[-1]
            ahead = {meet: 0.0}
            for i in range(meet, at):
                for j, score, _ in edges[i] if i in ahead else ():
                    ahead[j] = max(ahead.get(j, _NEG), ahead[i] + score)
            middle = ahead[at]
        else:
            meet, at = parts
            edges = [list(self.matches(s, i, meet)) for i in range(meet)]
            if middle is None:
                middle = self.encode(s[meet:at])[0]
        head, order = self._from_states(s, edges, meet, range(meet, meet + 1))
        ends = {at: middle}
        for i in range(at, length):
            if i in ends:
                for j, score, _ in self.matches(s, i, len(s)):
                    ends[j] = max(ends.get(j, _NEG), ends[i] + score)
        tail = [ends.get(length + e, _NEG) for e in range(w)]
        return np.stack([head[:, 0], order[:, 0], np.array(tail)])


_LOADED: dict[str, Vocabulary] = {}
MEMORIES["vocabularies"] = _LOADED.clear


def vocabulary(path: str) -> Vocabulary:
    drop_memos("vocabularies")
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def full(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and orders of a transfer matrix of either form."""
    w = matrix.shape[1]
    if len(matrix) == 3:
        return matrix[0][:, None] + matrix[2][None, :], np.repeat(matrix[1][:, None], w, axis=1)
    return matrix[:w], matrix[w:]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: of equal sums the state in between that comes first into the exit."""
    (m1, r1), (m2, r2) = full(a), full(b)
    ways = m1[:, :, None] + m2[None, :, :]
    best = ways.max(axis=1)
    between = np.where(ways == best[:, None, :], r2[None, :, :], np.inf).argmin(axis=1)
    columns = np.arange(m2.shape[1])[None, :]
    order = r2[between, columns] * m2.shape[1] + np.take_along_axis(r1, between, axis=1)
    # Entries without a way to an exit stand behind those with one.
    order = np.where(best == _NEG, np.inf, order).argsort(axis=0, kind="stable").argsort(axis=0, kind="stable")
    return np.concatenate([best, order.astype(np.float64)])


def states(matrices: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """States at the boundaries between matrices on the best way from entry to exit."""
    parts = [full(m) for m in matrices]
    reach = [np.where(np.arange(matrices[0].shape[1]) == entry, 0.0, _NEG)]
    for m, _ in parts[:-1]:
        reach.append((reach[-1][:, None] + m).max(axis=0))
    out = [exit_]
    for (m, r), before in zip(reversed(parts[1:]), reversed(reach[1:])):
        sums = before + m[:, out[-1]]
        out.append(int(np.where(sums == sums.max(), r[:, out[-1]], np.inf).argmin()))
    return out[::-1]


def _bytes(matrix: np.ndarray) -> bytes:
    return bytes([3 if len(matrix) == 3 else 0]) + matrix.astype("<f8").tobytes()


def _matrix(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, "<f8", offset=1)
    return flat.reshape(3, -1) if data[0] else flat.reshape(-1, int((len(flat) // 2) ** 0.5))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _whole(docs: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for incoming in batches:
            n = incoming.num_rows
            ids, counts, _ = v.encode_all([v.normalize(t) for t in incoming.column(1).to_pylist()])
            yield batch(_ENCODED, [incoming.column(0), [None] * n, [0] * n, _lists(ids, counts)])

    return docs.select("doc_id", "text").mapInArrow(run, _DDL)


def _chunks(giants: DataFrame, path: str, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        schema = pa.schema(
            [("key", pa.int64()), ("doc_id", pa.int64()), ("node", pa.int64()), ("length", pa.int64()), ("part", pa.string())]
        )
        for incoming in batches:
            for key, doc_id, text in zip(*(incoming.column(i).to_pylist() for i in range(3))):
                s = v.normalize(text)
                starts = range(0, len(s), chunk)
                parts = [s[at : at + chunk + v.longest - 1] for at in starts]
                lengths = [min(chunk, len(s) - at) for at in starts]
                n = len(parts)
                yield batch(schema, [[key] * n, [doc_id] * n, list(range(n)), lengths, parts])

    return giants.mapInArrow(run, "key long, doc_id long, node long, length long, part string")


def _by_node(chunks: DataFrame) -> DataFrame:
    """Chunks written in buckets by (key, node): those of one text are spread over tasks, and meet their states without a shuffle."""
    spark = chunks.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    writer = chunks.repartition(buckets, "key", "node").write.bucketBy(buckets, "key", "node").sortBy("key", "node")
    writer.options(path=new_folder(spark, "chunks"), compression="zstd").saveAsTable(name)
    stored = spark.table(name)
    # Only the name goes; the files stay, as the table lies outside the warehouse.
    spark.sql(f"DROP TABLE {name}")
    return stored


def _transfers(chunks: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("m", pa.binary())])
        for incoming in batches:
            lengths, strings = incoming.column(2).to_pylist(), incoming.column(3).to_pylist()
            # Whole words in the middle are on every path, so their sum decides nothing and is left out.
            m = [_bytes(v.transfer(s, n, 0.0)) for s, n in zip(strings, lengths)]
            yield batch(schema, [incoming.column(0), incoming.column(1), m])

    return chunks.select("key", "node", "length", "part").mapInArrow(run, "key long, node long, m binary")


def _families(level: DataFrame) -> DataFrame:
    """Children of each node of the next level, at most ``FAN``, in order."""
    children = F.sort_array(F.collect_list(F.struct("node", "m")))
    return level.groupBy("key", F.floor(F.col("node") / FAN).alias("parent")).agg(children.alias("children"))


def _products(families: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("m", pa.binary())])
        for incoming in batches:
            out = []
            for children in incoming.column(2).to_pylist():
                total = _matrix(children[0]["m"])
                for child in children[1:]:
                    total = times(total, _matrix(child["m"]))
                out.append(_bytes(total))
            yield batch(schema, [incoming.column(0), incoming.column(1), out])

    return families.mapInArrow(run, "key long, node long, m binary")


def _descend(families: DataFrame, bounds: DataFrame) -> DataFrame:
    """Entry and exit states of the children from those of their parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("entry", pa.int64()), ("exit", pa.int64())])
        for incoming in batches:
            for key, children, entry, exit_ in zip(*(incoming.column(i).to_pylist() for i in range(4))):
                between = states([_matrix(c["m"]) for c in children], entry, exit_)
                yield batch(schema, [[key] * len(children), [c["node"] for c in children], [entry, *between[:-1]], between])

    joined = families.join(bounds.withColumnRenamed("node", "parent"), ["key", "parent"])
    return joined.select("key", "children", "entry", "exit").mapInArrow(run, "key long, node long, entry long, exit long")


def _trace(chunks: DataFrame, bounds: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for incoming in batches:
            doc_id, key, node, length, part, entry, exit_ = (incoming.column(i) for i in range(7))
            traced = [v.trace(s, n, a, b) for n, s, a, b in zip(*(c.to_pylist() for c in (length, part, entry, exit_)))]
            middle, counts, _ = v.encode_all([words for _, words, _ in traced])
            runs: list = []
            sizes = np.zeros(len(traced), np.int64)
            at = 0
            for k, (head, _, tail) in enumerate(traced):
                runs += [head, middle[at : at + counts[k]], tail]
                at += counts[k]
                sizes[k] = len(head) + counts[k] + len(tail)
            ids = np.concatenate([np.asarray(r, np.int32) for r in runs]) if runs else middle
            yield batch(_ENCODED, [doc_id, key, node, _lists(ids, sizes)])

    joined = chunks.join(bounds, ["key", "node"])
    return joined.select("doc_id", "key", "node", "length", "part", "entry", "exit").mapInArrow(run, _DDL)


def encode_parts(docs: DataFrame, path: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """Ids of the texts that fit a chunk, a row each, and those of the longer ones, a row per chunk (None without any).

    Both have the columns of ``encode``.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    whole = _whole(texts.filter(F.length("text") <= chunk), path)
    long = texts.filter(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    chunks = _by_node(_chunks(long, path, chunk))
    last = chunks.agg(F.max("node")).first()[0]
    if last is None:
        return whole, None
    level = _transfers(chunks, path)
    tree = []
    while True:
        tree.append(staged(_families(level), "families"))
        last //= FAN
        if last == 0:
            break
        level = _products(tree[-1])
    bounds = tree[-1].select("key", F.col("parent").alias("node"), F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("exit"))
    for families in reversed(tree):
        bounds = _descend(families, bounds)
    return whole, _trace(chunks, staged(bounds, "bounds"), path)


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """Ids of every text: ``doc_id, key, chunk, ids``; a text longer than a chunk has a row per chunk and a ``key`` of its own.

    Null and empty texts have one row without ids; an empty table gives an empty table. Repeated or null
    ``doc_id`` are rows like any other; other columns are not read, whatever their names. A text may have
    any length. ``chunk`` must exceed the longest piece; it does not change the ids of a text.
    """
    whole, chunked = encode_parts(docs, path, chunk)
    return whole if chunked is None else whole.unionByName(chunked)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Text of each row of ids, chunk by chunk: ``doc_id, key, chunk, ids, text``.

    No character is split between chunks, so the texts of a document's chunks just follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        schema = pa.schema([*_ENCODED, ("text", pa.string())])
        for incoming in batches:
            ids, ends = _flat(incoming.column(3))
            ids, texts, start = ids.tolist(), [], 0
            for end, c in zip(ends.tolist(), incoming.column(2).to_pylist()):
                texts.append(v.decode(ids[start:end], c == 0))
                start = end
            yield batch(schema, [*(incoming.column(i) for i in range(4)), texts])

    return encoded.mapInArrow(run, f"{_DDL}, text string")


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists one after another, and where each list ends among them."""
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(counts)


def _sums(decoded: DataFrame) -> DataFrame:
    """Per row of ``decoded`` and of its ids (n, s, w) and characters (n2, s2, w2): count, sum, sum weighted by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("n", pa.int64()), ("s", pa.string()), ("w", pa.string()), ("n2", pa.int64()), ("s2", pa.string()), ("w2", pa.string())]
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("chunk", pa.int64()), *kinds])
        for incoming in batches:
            out: list[list] = [[] for _ in kinds]
            ids, ends = _flat(incoming.column(3))
            ids, start = ids.astype(np.int64), 0
            for end, text in zip(ends.tolist(), incoming.column(4).to_pylist()):
                points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
                row: list = []
                for values in (ids[start:end], points):
                    # Blocks whose weighted sums fit 64 bits.
                    weighted = 0
                    for i in range(0, len(values), 1 << 20):
                        part = values[i : i + (1 << 20)]
                        weighted += int(np.dot(part, np.arange(1, len(part) + 1))) + i * int(part.sum())
                    row += [len(values), str(int(values.sum())), str(weighted)]
                start = end
                for column, value in zip(out, row):
                    column.append(value)
            yield batch(schema, [*(incoming.column(i) for i in range(3)), *out])

    return decoded.mapInArrow(run, "doc_id long, key long, chunk long, n long, s string, w string, n2 long, s2 string, w2 string")


def digests(whole: DataFrame, chunked: DataFrame | None = None) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sum, n_chars, chars_sum``, from decoded rows of both parts.

    ``ids_sum`` adds (position + 1) * id over the document's ids, ``chars_sum`` likewise over the code
    points of the decoded text; both as whole numbers in text form.
    """
    number = "decimal(38,0)"
    alone = _sums(whole).select(
        "doc_id", F.col("n").alias("n_tokens"), F.col("w").alias("ids_sum"), F.col("n2").alias("n_chars"), F.col("w2").alias("chars_sum")
    )
    if chunked is None:
        return alone
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    giants = _sums(chunked)
    for n, s, w in (("n", "s", "w"), ("n2", "s2", "w2")):
        ahead = F.coalesce(F.sum(n).over(before), F.lit(0)).cast("decimal(18,0)")
        total = (F.col(w).cast(number) + ahead * F.col(s).cast("decimal(19,0)")).cast(number)
        giants = giants.withColumn(f"t_{w}", total)
    giants = giants.groupBy("key", "doc_id").agg(
        F.sum("n").alias("n_tokens"),
        F.sum("t_w").cast(number).cast("string").alias("ids_sum"),
        F.sum("n2").alias("n_chars"),
        F.sum("t_w2").cast(number).cast("string").alias("chars_sum"),
    )
    return alone.unionByName(giants.drop("key"))
