"""Quality classifier by importance resampling.

Two generative models over hashed n-grams: the target's, from a bounded sample of texts labelled
good, and the raw one, from all texts. Both are bags of words and word pairs (runs of letters and
digits, and runs of other characters) hashed to ``BUCKETS`` buckets. A text's log importance is the mean
log ratio of the two models over its n-grams. Texts are drawn without replacement in proportion
to exp(log importance / temperature), by Gumbel top-k: the k largest sums of scaled log importance
and Gumbel noise. The noise is a hash of the text, so that a draw repeats and equal texts
fare alike.

k follows from the data unless given: as many texts as reach the edge, the log importance that best
separates the good rows of the held-out half of the labelled sample from the bad ones, but at most
what ``LEAST_SHARE`` of those good rows reach; without bad rows, what ``keep_share`` of them reach. A
few wrong labels hardly move it. Where the two kinds lie apart by much more than the temperature, the draw is a
classifier.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.llm.common import batch, drop_memos, mix, one_text_per_id, small_batches, staged, text_bytes, word_hashes

BUCKETS = 1 << 16
SAMPLE = 20_000
KEEP_SHARE = 0.99
LEAST_SHARE = 0.95
TEMPERATURE = 0.002
SMOOTHING = 1.0
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
_BLOCK = 1 << 22


def gram_buckets(data: bytes) -> Iterator[np.ndarray]:
    """Buckets of the words and word pairs of a text, in slices."""
    low = data.lower()
    before = None
    words: list[bytes] = []

    def settle() -> Iterator[np.ndarray]:
        nonlocal before
        h = word_hashes(words)
        if before is not None:
            h = np.r_[before, h]
        single = mix(h[(before is not None) :] + np.uint64(1)) % np.uint64(BUCKETS)
        double = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) % np.uint64(BUCKETS)
        before = h[-1:]
        yield np.concatenate([single, double]).astype(np.int64)

    for found in _TOKEN.finditer(low) if len(low) > _BLOCK else ():
        words.append(found.group())
        if len(words) == 100_000:
            yield from settle()
            words = []
    if len(low) <= _BLOCK:
        words = _TOKEN.findall(low)
    if words:
        yield from settle()


def _counts(texts: DataFrame) -> np.ndarray:
    """Bucket counts over all texts: a row per task and bucket, summed; the result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos(keep="hashes")
        total = np.zeros(BUCKETS, np.int64)
        for incoming in batches:
            for data in incoming.column(0).to_pylist():
                for buckets in gram_buckets(data):
                    total += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield batch(pa.schema([("bucket", pa.int64()), ("n", pa.int64())]), [used, total[used]])

    out = np.zeros(BUCKETS)
    for row in texts.select("data").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[row[0]] = row[1]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of target over raw probability of each bucket; the target is smoothed towards the raw model."""
    raw_p = (raw + smoothing) / (raw.sum() + smoothing * len(raw))
    weight = smoothing * len(raw) * target.sum() / max(raw.sum(), 1.0)
    target_p = (target + weight * raw_p) / (target.sum() + weight) if target.sum() else raw_p
    return np.log(target_p) - np.log(raw_p)


def with_log_importance(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``row`` (all columns), ``n_grams`` and ``log_importance`` (0 for texts without n-grams)."""
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_bytes().alias("data"))
    source = source.withColumn("noise_key", F.xxhash64("data", F.lit(11)))
    schema = T.StructType(
        [
            T.StructField("row", source.schema["row"].dataType),
            T.StructField("noise_key", T.LongType()),
            T.StructField("n_grams", T.LongType()),
            T.StructField("log_importance", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos(keep="hashes")
        for incoming in batches:
            sizes, scores = [], []
            for data in incoming.column(1).to_pylist():
                n, total = 0, 0.0
                for buckets in gram_buckets(data):
                    n += len(buckets)
                    total += float(ratio[buckets].sum())
                sizes.append(n)
                scores.append(total / n if n else 0.0)
            arrays = [incoming.column(0), incoming.column(2), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def gumbel(key: Column) -> Column:
    """Standard Gumbel noise from a 64-bit hash."""
    unit = (F.shiftrightunsigned(key, 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(unit))


def threshold_of_top(scored: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, by narrowing a histogram; the driver sees counts only."""
    low, high, n = scored.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return low
    bins, above = 1024, 0
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        inside = scored.filter(F.col(column).between(low, high))
        number = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        found = inside.groupBy(number.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("x"), F.max(column).alias("y")
        )
        for row in sorted(found.collect(), key=lambda r: -r.b):
            if above + row.n >= k:
                break
            above += row.n
        if row.x == row.y or above + row.n == k:
            return row.x
        low, high = row.x, row.y


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labelled rows (those with the lowest id hash), a text per id: ``data, quality, held``."""
    some = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id")
        .limit(size)
    )
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    return one_text_per_id(docs, some).select("data", "quality", held.alias("held"))


def edge_of(good: np.ndarray, bad: np.ndarray, keep_share: float = KEEP_SHARE) -> float | None:
    """The least log importance that counts as good; None without good rows.

    Midway between neighbours where the share of good rows that reach it less the share of bad rows
    that do is largest (the lowest such place), but at most what ``LEAST_SHARE`` of the good rows reach.
    Without bad rows, what ``keep_share`` of the good rows reach.
    """
    if not len(good):
        return None
    if not len(bad):
        return float(np.quantile(good, 1 - keep_share))
    values = np.unique(np.r_[good, bad])
    places = np.r_[values[0], (values[:-1] + values[1:]) / 2]
    reach = [1 - np.searchsorted(np.sort(x), places, "left") / len(x) for x in (good, bad)]
    best = float(places[np.argmax(np.round(reach[0] - reach[1], 12))])
    return min(best, float(np.quantile(good, 1 - LEAST_SHARE)))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    sample: int = SAMPLE,
    keep_share: float = KEEP_SHARE,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Per row of ``docs``: ``row, n_grams, log_importance, key, kept``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good); at most ``sample`` labelled rows are used, one half of
    the good ones for the target model and the other half, with the bad ones, to set k. Without good rows
    every text is kept. Of several texts with one labelled id the sample takes one. Texts without n-grams have log importance 0,
    an empty table gives an empty one. Equal texts have equal keys,
    so ties at the k-th place are all kept. Columns travel as one value.
    """
    small_batches(docs.sparkSession)
    learn = _sample(docs, labels, sample)
    target = _counts(learn.filter("quality = 1 and not held"))
    raw = _counts(docs.select(text_bytes().alias("data")))
    ratio = log_ratio(target, raw)
    scored = staged(with_log_importance(docs, ratio), "importance")
    keyed = scored.withColumn("key", F.col("log_importance") / F.lit(temperature) + gumbel(F.col("noise_key")))
    if k is None:
        held = with_log_importance(learn.filter("held").select("quality", F.col("data").alias("text")), ratio)
        found = held.select("row.quality", "log_importance").collect()  # at most ``sample`` pairs
        good, bad = (np.array([x for q, x in found if (q == 1) == kind]) for kind in (True, False))
        edge = edge_of(good, bad, keep_share)
        k = scored.count() if edge is None else scored.filter(F.col("log_importance") >= edge).count()
    least = threshold_of_top(keyed, "key", k)
    kept = F.lit(False) if least is None else F.col("key") >= least
    return keyed.select("row", "n_grams", "log_importance", "key", kept.alias("kept"))
