"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text, one on ordinary text and one on what
recurs in toxic text and is rare in ordinary text. The ordinary compressor has the first as its
dictionary, the toxic one has both, so a window that compresses shorter with the second holds what
the toxic dictionary alone has. A window is a word, repeated so that it is long enough to be
compressed at all. It is flagged if the toxic dictionary saves at least ``min_gain`` bytes and
leaves at most ``max_length``; both thresholds are calibrated on the labelled sample, as is the
probability that a text with so many flagged windows is toxic. Of a text's flagged windows, twice as
many as ordinary text of its length has are not counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import MEMO_WORDS, batch, one_text_per_id, small_batches, text_bytes

# Bounds of the fit: labelled rows, windows of ordinary text, words peculiar to toxic text.
SAMPLE = 8_000
ORDINARY_WINDOWS = 20_000
PECULIAR_WORDS = 2_000
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 32_768
# A word peculiar to toxic texts is in so many at least, and would be in that many by chance with less than this probability.
LEAST_TEXTS = 3
CHANCE = 1e-3
LEVEL = 12
REPEATS = 8
THRESHOLD = 0.7
_WINDOW_WORDS = 40
_GAINS = (1, 2, 3, 4)
_LENGTHS = tuple(range(10, 21))
_LONGEST = 64
_TOP = 5  # flagged windows beyond this number count as this many


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    min_gain: int
    max_length: int
    rate: float
    table: tuple[float, ...]


class Measure:
    """Compressed lengths of windows under both dictionaries, remembered per word."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.memo: dict[bytes, tuple[int, int]] = {}
        self.ordinary = self._press(ordinary)
        self.toxic = self._press(ordinary + toxic)

    @staticmethod
    def _press(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) > 8 else None
        return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)

    def lengths(self, word: bytes) -> tuple[int, int]:
        found = self.memo.get(word)
        if found is None:
            window = (b" " + word) * REPEATS + b" "
            found = len(self.ordinary.compress(window)), len(self.toxic.compress(window))
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            if len(word) <= _LONGEST:
                self.memo[word] = found
        return found


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(data: bytes) -> list[bytes]:
    return data.lower().split()


def train(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _peculiar(sample: DataFrame) -> list[bytes]:
    """Words that recur in toxic texts and are far rarer in ordinary ones, counted by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("toxic", pa.int32())])
        for incoming in batches:
            for data, toxic in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                found = [w for w in set(_words(data)) if len(w) <= _LONGEST]
                yield batch(schema, [found, [toxic] * len(found)])

    totals = {r[0]: r[1] for r in sample.groupBy("toxic").agg(F.count(F.lit(1))).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    share = F.lit(bad / max(bad + good, 1))
    t, plain = F.col("t"), F.col("n") - F.col("t")
    # Chernoff's bound of the binomial tail.
    rest = F.when(plain > 0, plain * F.log(plain / (F.col("n") * (1 - share)))).otherwise(0.0)
    evidence = t * F.log(t / (F.col("n") * share)) + rest
    counts = (
        sample.select("data", "toxic")
        .mapInArrow(run, "word binary, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
        .filter((t >= LEAST_TEXTS) & (t * max(good, 1) > 8.0 * bad * plain))
        .filter(evidence >= -math.log(CHANCE))
        .orderBy(F.desc("t"), "word")
        .limit(PECULIAR_WORDS)
    )
    return [bytes(r.word) for r in counts.collect()]


def _samples(sample: DataFrame, peculiar: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Training windows: ordinary text without the peculiar words, and those words as they follow in toxic texts."""
    marked = frozenset(peculiar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("window", pa.binary()), ("toxic", pa.int32())])
        for incoming in batches:
            for data, toxic in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                words = [w for w in _words(data) if (w in marked) == bool(toxic)]
                windows = [b" " + b" ".join(words[i : i + _WINDOW_WORDS]) + b" " for i in range(0, len(words), _WINDOW_WORDS)]
                yield batch(schema, [windows, [toxic] * len(windows)])

    cut = sample.select("data", "toxic").mapInArrow(run, "window binary, toxic int")
    chosen = [
        cut.filter(F.col("toxic") == t).orderBy(F.xxhash64("window"), "window").limit(ORDINARY_WINDOWS).collect() for t in (0, 1)
    ]
    return [bytes(r.window) for r in chosen[0]], [bytes(r.window) for r in chosen[1]]


def _calibrate(sample: DataFrame, ordinary: bytes, toxic: bytes) -> Model:
    """Thresholds and probabilities under which the sample's labels are likeliest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(ordinary, toxic)
        schema = pa.schema([("toxic", pa.int32()), ("n", pa.int64()), ("counts", pa.list_(pa.int64()))])
        for incoming in batches:
            sizes, found = [], []
            for data in incoming.column(0).to_pylist():
                pairs = np.array([measure.lengths(w) for w in _words(data)] or [(0, 99)])
                gain, length = pairs[:, 0] - pairs[:, 1], pairs[:, 1]
                sizes.append(len(pairs))
                found.append([int(((gain >= g) & (length <= c)).sum()) for g in _GAINS for c in _LENGTHS])
            yield batch(schema, [incoming.column(1), sizes, found])

    rows = sample.select("data", "toxic").mapInArrow(run, "toxic int, n long, counts array<long>").collect()
    labels = np.array([r.toxic for r in rows])
    sizes = np.array([r.n for r in rows])
    flagged = np.array([r.counts for r in rows]).reshape(len(rows), -1)
    plain = labels == 0
    best: tuple[float, Model] | None = None
    for i, (gain, length) in enumerate((g, c) for g in _GAINS for c in _LENGTHS):
        rate = float(flagged[plain, i].sum() / max(sizes[plain].sum(), 1))
        counts = excess(flagged[:, i], sizes, rate)
        table = _table(counts, labels)
        p = np.array(table)[counts]
        fit = float((labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum())
        if best is None or fit > best[0] + 1e-9:
            best = (fit, Model(ordinary, toxic, gain, length, rate, table))
    return best[1]


def excess(flagged: np.ndarray, sizes: np.ndarray, rate: float) -> np.ndarray:
    """Flagged windows beyond twice what ordinary text of that length has, up to the largest number told apart."""
    return np.clip(flagged - np.floor(2 * rate * sizes).astype(np.int64), 0, _TOP)


def _table(counts: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Smoothed share of toxic texts by number of flagged windows, rising with it."""
    base = (labels.sum() + 0.5) / (len(labels) + 1.0)
    out, least = [], 0.0
    for c in range(_TOP + 1):
        at = counts == c
        least = max(least, float((labels[at].sum() + base) / (at.sum() + 1.0)))
        out.append(least)
    return tuple(out)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows (those with the lowest id hash) that are not held out, a text per id."""
    small_batches(docs.sparkSession)
    some = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(~held_out())
        .orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
        .limit(sample)
    )
    learnt = one_text_per_id(docs, some).select("data", "toxic")
    peculiar = _peculiar(learnt)
    plain, bad = _samples(learnt, peculiar)
    ordinary = train(plain, ORDINARY_BYTES) if plain else b""
    toxic = (train(bad, TOXIC_BYTES) if bad else b"") + b" " + b" ".join(reversed(peculiar)) + b" "
    if learnt.isEmpty():
        return Model(ordinary, toxic, 99, 0, 0.0, (0.5,) * (_TOP + 1))
    return _calibrate(learnt, ordinary, toxic)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted, n_flagged``.

    Null and empty texts have no window and get the score of texts without a flagged one. Only the
    text is scored; rows with a null or repeated ``doc_id`` are rows like any other, a null
    one not being held out.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(model.ordinary, model.toxic)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_flagged", pa.int64())]
        )

        def flagged(word: bytes) -> bool:
            plain, toxic = measure.lengths(word)
            return plain - toxic >= model.min_gain and toxic <= model.max_length

        for incoming in batches:
            texts = [_words(data) for data in incoming.column(2).to_pylist()]
            counts = np.array([sum(map(flagged, words)) for words in texts], np.int64)
            beyond = excess(counts, np.array([len(words) for words in texts], np.int64), model.rate)
            scores = np.array(model.table)[beyond].tolist()
            yield batch(schema, [incoming.column(0), incoming.column(1), scores, [int(s >= THRESHOLD) for s in scores], counts])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("data")
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_flagged long")
