"""Importance resampling towards a target distribution, with an exact draw of the highest scores.

Every text is a bag of hashed word runs. Two arrays of counts, one over all texts and one over the
target's, give an array with the gain of each bucket; a text's weight is the floored mean gain of its
features, looked up in that array. Gumbel noise from a hash of the id is added, and the highest
scores among texts of enough words are drawn.

The cutoff of the draw is bracketed instead of sorting all rows: a quantile sketch proposes a lower
and an upper value around the wanted place, exact counts of the rows outside tell whether the
place lies between them, the bracket is widened where it does not and narrowed by another sketch where it is
still large, and only the rows of the last bracket are sorted. Ties go on to the next column
of the order in the same way. The drawn rows alone are then sorted by ranges to number them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import MEMO_WORDS, batch, pieces_at_spaces, small_batches, staged, text_bytes

BUCKETS = 10_000
# Rows of a bracket that are sorted; a larger bracket is narrowed first.
BRACKET = 100_000
ACCURACY = 10_000
_LAST = 2**63 - 1
# A-Z in lower case; every other byte below 0x80 that is no letter or digit becomes a space.
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
_COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
_WEIGHTS = pa.schema(
    [("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())]
)


class _Buckets(dict):
    """Feature -> bucket, remembered within a task and emptied when full."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        value = zlib.crc32(feature) % self.buckets
        if len(self) >= MEMO_WORDS:
            self.clear()
        if len(feature) <= 64:
            self[feature] = value
        return value


def feature_buckets(data: bytes, longest: int, known: _Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of the runs that end in them) of a text, in slices."""
    before: list[bytes] = []
    for piece in pieces_at_spaces(data):
        new = piece.translate(_FOLD).split()
        words = before + new
        parts = []
        for k in range(1, longest + 1):
            first = max(len(before) - k + 1, 0)  # the first run of k words that ends in a new word
            runs = words[first:] if k == 1 else [b" ".join(words[i : i + k]) for i in range(first, len(words) - k + 1)]
            parts.append(np.fromiter(map(known.__getitem__, runs), np.int64, len(runs)))
        before = words[len(words) - longest + 1 :] if longest > 1 else []
        yield len(new), np.concatenate(parts)


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all of ``texts``: one row per task and bucket is summed, whatever the size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for incoming in batches:
            for data in incoming.column(0).to_pylist():
                for _, found in feature_buckets(data, longest, known):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield batch(_COUNTS, [used, total[used]])

    out = np.zeros(buckets, np.int64)
    counted = texts.select(text_bytes().alias("data")).mapInArrow(run, "bucket long, n long")
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))) of every bucket."""
    buckets = len(raw)
    up = (target + 1.0) * float(raw.sum() + buckets)
    down = (raw + 1.0) * float(target.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, th, n_words, n_features, weight`` of every row; ``th`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gain))
        for incoming in batches:
            words, features, means = [], [], []
            for data in incoming.column(2).to_pylist():
                n = n_features = total = 0
                for new, found in feature_buckets(data, longest, known):
                    n += new
                    n_features += len(found)
                    total += int(gain[found].sum())
                words.append(n)
                features.append(n_features)
                means.append(total // n_features if n_features else 0)
            yield batch(_WEIGHTS, [incoming.column(0), incoming.column(1), words, features, means])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("th"), text_bytes().alias("data"))
    return source.mapInArrow(run, "doc_id long, th long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 x standard Gumbel noise) from 32 bits of a hash of the id (a null id counts as empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def value_at(rows: DataFrame, column: str, k: int, accuracy: int = ACCURACY, bracket: int = BRACKET) -> tuple[int, int, int]:
    """The k-th smallest value (from 1) of a whole-number column, the rows below it and the rows that have it.

    ``k`` lies between 1 and the number of rows; the column has no nulls.
    """
    c = F.col(column)
    low, high, n = rows.agg(F.min(c), F.max(c), F.count(c)).first()
    below, inside, margin = 0, n, 2.0 / accuracy
    while low < high:
        if inside <= bracket:
            value = rows.filter(c.between(low, high)).orderBy(c).offset(k - below - 1).limit(1).first()[column]
            low = high = value
        else:
            place = (k - below) / inside
            shares = [max(place - margin, 0.0), min(place + margin, 1.0)]
            a, b = rows.filter(c.between(low, high)).agg(F.percentile_approx(c, F.array(*map(F.lit, shares)), accuracy)).first()[0]
            if (a, b) == (low, high):  # a bracket of few values, or many equal ones: halve it
                a, b = low, (low + high) // 2
            less, within = _outside(rows, c, a, b)
            if less >= k:  # the place lies below the bracket
                low, high, inside, margin = low, a - 1, less - below, margin * 2
                continue
            if less + within < k:  # or above it
                inside -= less + within - below
                low, below, margin = b + 1, less + within, margin * 2
                continue
            low, high, below, inside = a, b, less, within
    below, inside = _outside(rows, c, low, low)
    return low, below, inside


def _outside(rows: DataFrame, c: Column, low: int, high: int) -> tuple[int, int]:
    """Exact numbers of rows below ``low`` and between ``low`` and ``high``."""
    return tuple(rows.agg(F.count_if(c < low), F.count_if(c.between(low, high))).first())


def smallest(rows: DataFrame, order: list[str], k: int, accuracy: int = ACCURACY, bracket: int = BRACKET) -> Column:
    """Condition that holds for the k smallest rows by ``order`` (all rows equal to the k-th included)."""
    if k <= 0:
        return F.lit(False)
    value, below, equal = value_at(rows, order[0], k, accuracy, bracket)
    c = F.col(order[0])
    if below + equal == k or len(order) == 1:
        return c <= value
    rest = smallest(rows.filter(c == value), order[1:], k - below, accuracy, bracket)
    return (c < value) | ((c == value) & rest)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``rank`` from 1 by ``order``: sorted by ranges, numbered within, ahead of them the counts of earlier ranges."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = staged(sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", within), "ranked")
    ahead, starts = 0, []
    for part, n in sorted(numbered.groupBy("_part").count().collect()):  # a row per partition
        starts.append((part, ahead))
        ahead += n
    offsets = rows.sparkSession.createDataFrame(starts, "_part int, _ahead long")
    found = numbered.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_ahead") + F.col("_at") + 1)
    return found.drop("_part", "_at", "_ahead")


def resample_to_target(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    accuracy: int = ACCURACY,
    bracket: int = BRACKET,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_features, weight, score, rank``; rank is null for rows not drawn.

    ``target`` needs a column ``text``, ``docs`` also ``doc_id``; other columns are not read. Words are
    runs of ASCII letters and digits and of all characters beyond ASCII. Of the N rows with at least
    ``min_words`` words the floor(``percent`` N / 100) highest scores are drawn, ties by smaller ``doc_id`` (null
    last), then by text hash; repeated rows are rows like any other. Null and empty texts have no features and weight 0.
    An empty ``docs`` gives no rows, an empty ``target`` counts of 0. Texts of any length are read whole, in slices.
    """
    small_batches(docs.sparkSession)
    gain = gains(bucket_counts(target, longest, buckets), bucket_counts(docs, longest, buckets))
    found = weights(docs, gain, longest)
    scored = staged(found.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long")), "target-scores")
    keyed = scored.withColumns({"_down": -F.col("score"), "_doc": F.coalesce("doc_id", F.lit(_LAST))})
    eligible = keyed.filter(F.col("n_words") >= min_words)
    k = eligible.count() * percent // 100
    order = ["_down", "_doc", "th"]
    drawn = (F.col("n_words") >= min_words) & smallest(eligible, order, k, accuracy, bracket)
    columns = ["doc_id", "n_features", "weight", "score"]
    first = ranked(keyed.filter(drawn), order)
    rank = F.when(F.col("rank") <= k, F.col("rank"))  # of rows equal to the last one drawn, the surplus
    rest = keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.select(*columns, rank.alias("rank")).unionByName(rest)
