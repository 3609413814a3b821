"""Spelling variants of a corpus' words, found by range searches in k-d trees over letter counts.

A word is a point: how often it holds each letter. One replaced letter moves the point by an L1 distance of
two and keeps the length, one letter more or less moves it by one; words with the same letters in another
order share a point and are never one edit apart. So the search runs over distinct points:

1. Words are counted in tasks first, then over all texts.
2. Per length, the points are dealt to cells by the upper levels of a k-d tree, whose splits come from a
   bounded sample of points. A point is also sent as a query to every cell whose box lies
   within two of it among points of its length, and within one among points one letter longer.
3. A task meets the points of a cell first and builds the rest of the tree over them; queries then
   stream by, in batches that prune the boxes beyond their distance.
4. A pair of points tells which letters are surplus. Words of both are joined on what is left once a surplus letter is
   taken out, which verifies the order of the letters without comparing all words of two points.
5. Each word's near words give its form, and forms are followed to their roots by doubling steps.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import MEMO_WORDS, batch, small_batches, staged

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
# Points aimed at per cell, cells of one length at most, and points sampled for the upper levels.
CELL = 2_000
MAX_CELLS = 2_048
SAMPLE = 100_000
_LEAF = 24
_SLICE = 1 << 20
# Words up to this length leave one rest per place; longer ones are joined by their halves.
_SHORT = 64
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_AXES = np.full(0x100, -1, np.int64)
_AXES[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_PAIRS = pa.schema([("a", pa.string()), ("b", pa.string()), ("out", pa.string()), ("into", pa.string())])


def runs(text: str) -> Iterator[str]:
    """Maximal runs of letters, A-Z in lower case; long texts in slices."""
    at = 0
    while at < len(text):
        end = min(at + _SLICE, len(text))
        if end < len(text):  # a run that reaches over the end belongs to the next slice, or is longer than one
            last = _RUN.match(text[end - 1 : end]) and re.search("[A-Za-zÀ-ÿ]+$", text[at:end])
            if last and last.start() > 0:
                end = at + last.start()
            elif last:
                end = _RUN.match(text, at).end()
        yield from _RUN.findall(text[at:end].translate(_LOWER))
        at = end


def misspelt(run: str, start: int, every: int) -> str:
    """The run, less one letter where ``every`` divides its hash; ``start`` is the hash of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def corpus_words(docs: DataFrame, every: int, min_length: int) -> DataFrame:
    """``word, n`` over all texts, counted within tasks before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def settle() -> pa.RecordBatch:
            found = batch(_WORDS, [list(counts), list(counts.values())])
            counts.clear()
            return found

        for incoming in batches:
            for doc_id, text in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                own: dict[str, int] = {}
                for found in runs(text):
                    own[found] = own.get(found, 0) + 1
                for found, n in own.items():
                    word = misspelt(found, start, every)
                    if len(word) >= min_length:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= MEMO_WORDS:
                    yield settle()
        yield settle()

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts of each word."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    at = rows * len(LETTERS) + _AXES[flat]
    return np.bincount(at, minlength=len(words) * len(LETTERS)).reshape(len(words), -1).astype(np.int32)


def split(points: np.ndarray) -> tuple[int, int] | None:
    """(axis, value) that deals points most evenly to those up to the value and those above; None if all are equal."""
    best, found = 0, None
    middle = (len(points) - 1) // 2
    for axis in np.flatnonzero(points.max(axis=0) > points.min(axis=0)):
        column = np.sort(points[:, axis])
        for value in {int(column[middle]), int(column[middle]) - 1}:
            up_to = int(np.searchsorted(column, value, "right"))
            if min(up_to, len(column) - up_to) > best:
                best, found = min(up_to, len(column) - up_to), (int(axis), value)
    return found


class Cells:
    """Upper levels of a k-d tree: nodes are (axis, value, below, above) or the number of a cell."""

    def __init__(self, points: np.ndarray, cells: int, first: int = 0) -> None:
        self.first = first
        self.count = 0
        self.root = self._grow(points, cells)

    def _grow(self, points: np.ndarray, cells: int):
        cut = split(points) if cells > 1 and len(points) > 1 else None
        if cut is None:
            self.count += 1
            return self.first + self.count - 1
        below = points[:, cut[0]] <= cut[1]
        return (*cut, self._grow(points[below], cells // 2), self._grow(points[~below], cells - cells // 2))

    def home(self, points: np.ndarray) -> np.ndarray:
        """Cell of each point."""
        out = np.empty(len(points), np.int64)
        for cell, who in self.within(points, 0):
            out[who] = cell
        return out

    def within(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, points whose L1 distance to the cell's box is at most ``radius``).

        The box of a cell only has bounds on the axes that were split, so the distance is summed over those.
        """
        width = points.shape[1]
        todo = [(self.root, np.arange(len(points)), np.zeros((len(points), 0), np.int32), {})]
        while todo:
            node, who, gaps, axes = todo.pop()
            if isinstance(node, (int, np.integer)):
                yield int(node), who
                continue
            axis, value, below, above = node
            assert axis < width
            at = points[who, axis]
            for child, gap in ((below, np.maximum(at - value, 0)), (above, np.maximum(value + 1 - at, 0))):
                known = axes.get(axis)
                if known is None:
                    new, names = np.column_stack([gaps, gap]).astype(np.int32), {**axes, axis: gaps.shape[1]}
                else:
                    new, names = gaps.copy(), axes
                    new[:, known] = np.maximum(new[:, known], gap)
                keep = new.sum(axis=1) <= radius
                if keep.any():
                    todo.append((child, who[keep], new[keep], names))


class Tree:
    """k-d tree over the points of a cell, for batches of range queries."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, who: np.ndarray):
        some = self.points[who]
        cut = split(some) if len(who) > _LEAF else None
        if cut is None:
            return some.min(axis=0), some.max(axis=0), who, None, None
        below = some[:, cut[0]] <= cut[1]
        return some.min(axis=0), some.max(axis=0), who, self._grow(who[below]), self._grow(who[~below])

    def at_distance(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) exactly ``distance`` apart; boxes farther than that are pruned."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            (low, high, who, below, above), asking = todo.pop()
            some = queries[asking]
            gap = (np.maximum(low - some, 0) + np.maximum(some - high, 0)).sum(axis=1)
            asking = asking[gap <= distance]
            if not len(asking):
                continue
            if below is None:
                for i in range(0, len(asking), 512):
                    part = asking[i : i + 512]
                    apart = np.abs(queries[part][:, None, :] - self.points[who][None, :, :]).sum(axis=2)
                    q, p = np.nonzero(apart == distance)
                    yield part[q], who[p]
            else:
                todo += [(below, asking), (above, asking)]


def _point(word: Column) -> Column:
    """Name of a word's point: its letters in order."""
    return F.array_join(F.array_sort(F.split(word, "")), "")


def _sampled_cells(points: DataFrame, cell: int, max_cells: int, sample: int) -> dict[int, Cells]:
    """Upper levels per length, from at most ``sample`` points; one cell for a length that the sample misses."""
    sizes = dict(points.groupBy(F.length("point")).count().orderBy(F.desc("count")).limit(1000).collect())
    drawn = points.orderBy(F.xxhash64("point")).limit(sample).select(F.length("point").alias("l"), "point").collect()
    by_length: dict[int, list[str]] = {}
    for length, point in drawn:
        by_length.setdefault(length, []).append(point)
    out, first = {}, 0
    for length, some in sorted(by_length.items()):
        wanted = min(max_cells, -(-sizes.get(length, 1) // cell), len(some))
        out[length] = Cells(vectors(some), wanted, first)
        first += out[length].count
    return out


def near_points(points: DataFrame, cell: int = CELL, max_cells: int = MAX_CELLS, sample: int = SAMPLE) -> DataFrame:
    """Pairs of points one edit apart: ``a, b, out, into``.

    ``a`` becomes ``b`` when its letter ``out`` (none: empty) is replaced by ``into``; of equal length ``a`` < ``b``.
    """
    trees = _sampled_cells(points, cell, max_cells, sample)

    def cells_of(length: int) -> Cells | None:
        return trees.get(length)

    def number(length: int, cell_number: int) -> int:
        # Lengths without sampled points have one cell of their own.
        return cell_number if cell_number >= 0 else -length - 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("cell", pa.int64()), ("length", pa.int64()), ("kind", pa.int64()), ("point", pa.string())])
        for incoming in batches:
            by_length: dict[int, list[str]] = {}
            for point in incoming.column(0).to_pylist():
                by_length.setdefault(len(point), []).append(point)
            for length, some in by_length.items():
                at = vectors(some)
                names = np.array(some, object)
                home = cells_of(length)
                # Points of a cell come first (kind 0), queries later (kind: the distance asked for).
                for kind, tree, radius in ((0, home, 0), (2, home, 2), (1, cells_of(length + 1), 1)):
                    size = length + (kind == 1)
                    found = [(-1, np.arange(len(some)))] if tree is None else tree.within(at, radius)
                    for c, who in found:
                        n = len(who)
                        yield batch(schema, [np.full(n, number(size, c)), np.full(n, size), np.full(n, kind), names[who].tolist()])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, tree = None, [], None
        for incoming in batches:
            cells, kinds = (incoming.column(i).to_numpy() for i in (0, 2))
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
            for i, j in zip([0, *edges], [*edges, len(cells)]):
                if i == j:
                    continue
                names = incoming.column(3).slice(i, j - i).to_pylist()
                if cells[i] != current:
                    current, members, tree = cells[i], [], None
                if kinds[i] == 0:
                    members += names
                    continue
                if not members:
                    continue
                if tree is None:
                    tree = Tree(vectors(members))
                at = vectors(names)
                for q, p in tree.at_distance(at, int(kinds[i])):
                    if kinds[i] == 2:
                        once = np.array([names[x] < members[y] for x, y in zip(q, p)], bool)
                        q, p = q[once], p[once]
                    if not len(q):
                        continue
                    moved = tree.points[p] - at[q]
                    into = [LETTERS[x] for x in moved.argmax(axis=1)]
                    out = [LETTERS[x] for x in moved.argmin(axis=1)] if kinds[i] == 2 else [""] * len(q)
                    yield batch(_PAIRS, [[names[x] for x in q], [members[y] for y in p], out, into])

    dealt = points.select("point").mapInArrow(deal, "cell long, length long, kind long, point string")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "kind")
    return dealt.mapInArrow(search, "a string, b string, out string, into string")


def _left(word: Column, letter: Column, mark: Column) -> Column:
    """What a short word leaves when one ``letter`` is taken out (``mark`` in its place), per place; the word itself without one."""
    places = F.filter(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)) == letter)
    taken = F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), mark, F.substring(word, i + 1, F.length(word))))
    return F.when(letter == "", F.array(word)).otherwise(F.array_distinct(taken))


def _halves(word: Column, shorter: Column) -> Column:
    """Both ends of a long word; an edit leaves one of them as it was."""
    half = F.floor(shorter / 2).cast("int")
    rest = (shorter - half).cast("int")
    return F.array(
        F.concat(F.lit("<"), F.substring(word, F.lit(1), half)),
        F.concat(F.lit(">"), F.substring(word, F.length(word) - rest + 1, rest)),
    )


def near_words(words: DataFrame, **limits: int) -> DataFrame:
    """Ordered pairs of words one edit apart: ``word, near``; ``words`` has distinct ``word``."""
    named = staged(words.select("word", _point(F.col("word")).alias("point")), "points")
    pairs = staged(near_points(named.select("point").distinct(), **limits), "near-points")
    # A replaced letter leaves a mark where it stood, an added one leaves nothing.
    mark = F.when(F.col("out") == "", F.lit("")).otherwise(F.lit("*"))
    sides = []
    for side, letter in (("a", "out"), ("b", "into")):
        members = pairs.join(named.select(F.col("point").alias(side), "word"), side)
        short = _left(F.col("word"), F.col(letter), mark)
        left = F.when(F.length("a") <= _SHORT, short).otherwise(_halves(F.col("word"), F.length("a")))
        sides.append(members.select("a", "b", F.col("word").alias(f"w{side}"), F.explode(left).alias("left")))
    found = sides[0].join(sides[1], ["a", "b", "left"])
    one_edit = (F.length("a") <= _SHORT) | (F.levenshtein("wa", "wb", 1) == 1)
    found = found.filter(one_edit).select("wa", "wb")
    found = staged(found.distinct(), "near-words")
    both = found.select(F.col("wa").alias("word"), F.col("wb").alias("near"))
    return both.unionByName(found.select(F.col("wb").alias("word"), F.col("wa").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: each step doubles how many forms have been followed."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = staged(now.join(ahead, "root", "left"), "roots")
        if moved.filter("_next is not null").isEmpty():
            return now
        now = moved.select("word", F.coalesce("_next", "root").alias("root"))


def spelling_groups(
    docs: DataFrame,
    every: int = 199,
    min_length: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    cell: int = CELL,
    max_cells: int = MAX_CELLS,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per word: ``word, n, form, root, n_near, form_n``.

    Words are maximal runs of Latin letters (A-Z in lower case) of ``docs``' texts; where ``every`` divides the hash of
    ``<doc_id>:<run>`` (a null id counts as empty text) the run loses a letter. Words have at least ``min_length`` letters and
    occur ``min_count`` times. Words are near if one inserted, deleted or replaced letter makes one the other. The
    form is the near word that occurs most (ties: first in code-point order) if that is ``ratio`` (more than 1)
    times as often; the root is found by following forms. Null and empty texts have no words; an empty table
    gives no rows; repeated rows count again; texts of any length are read whole, in slices; columns other than
    ``doc_id`` and ``text`` are not read. Bounds: ``sample`` points and the cells they name reach all tasks.
    """
    small_batches(docs.sparkSession)
    words = staged(corpus_words(docs, every, min_length).filter(F.col("n") >= min_count), "words")
    near = near_words(words, cell=cell, max_cells=max_cells, sample=sample)
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near")))
    per_word = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    top = -F.col("best.down")
    enough = top >= ratio * F.col("n")
    told = staged(
        words.join(per_word, "word", "left").select(
            "word",
            "n",
            F.when(enough, F.col("best.near")).alias("form"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, top).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.filter("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )
