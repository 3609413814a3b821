"""Quality rules: plain text counts and tokeniser fertility.

A public vocabulary shows how far a text is from the text that it was made for: characters per
token, share of tokens that are bytes of characters it lacks, and entropy of the tokens (relative to the
most that so many tokens allow, at most ``ENTROPY_BITS``). Each has a band per language or,
for rows without a known language, per script. Short texts say too little and are judged
by the plain counts alone.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulario.llm.common import drop_memos, small_batches, text_bytes

_SYMBOLS = b"#*$%&|<>"
_OTHERS = bytes(i for i in range(256) if i not in _SYMBOLS)
ENTROPY_BITS = 12.0


# Length classes of the entropy floors: a class ends where the next begins.
CLASSES = (64, 128, 256, 512, 1024, 2048, 4096)


@dataclass(frozen=True)
class Band:
    """Accepted ranges, the least entropy by length class; a text outside any of them is rejected."""

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: tuple[float, ...]


# Bands by language, then by script. They lie outside what two samples show: the manual pages of a Debian system
# in 10 Latin-script and 4 other languages (paragraphs of running text, whole pages, and slices of them),
# and labelled good rows with an even doc_id of the test tables at 0.1. Floors are the least entropy of both less 0.01, those
# of all Latin-script languages where a class has fewer than 100 texts. Other scripts have a loose
# floor: text that the vocabulary spells in bytes repeats them. The most characters per token shown are 6.2, but short formal
# prose of long words reaches 8.
LANGUAGES = {
    "en": Band((1.4, 10.0), 0.15, (0.71, 0.62, 0.69, 0.65, 0.61, 0.56, 0.54)),
    "de": Band((1.4, 10.0), 0.15, (0.76, 0.67, 0.69, 0.64, 0.58, 0.54, 0.54)),
    "es": Band((1.4, 10.0), 0.15, (0.71, 0.62, 0.68, 0.63, 0.58, 0.54, 0.54)),
    "fr": Band((1.4, 10.0), 0.15, (0.73, 0.64, 0.68, 0.63, 0.58, 0.54, 0.54)),
}
SCRIPTS = {
    "latin": Band((1.4, 10.0), 0.25, (0.61, 0.61, 0.61, 0.61, 0.57, 0.53, 0.53)),
    "other": Band((0.25, 10.0), 0.75, (0.4,) * len(CLASSES)),
}
MIN_TOKENS = 64
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5

_LETTER = re.compile(r"[^\W\d_]")
_LATIN = re.compile("[A-Za-zªºÀ-ɏḀ-ỿ]")


def script(text: str) -> str:
    """``latin`` if at least half of the letters are, or there are none."""
    letters = len(_LETTER.findall(text))
    return "latin" if 2 * len(_LATIN.findall(text)) >= letters else "other"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more in the text, the first included."""
    grams = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(grams)
    if len(counts) == len(grams):
        return 0
    covered, end = 0, 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += i + window - max(i, end)
            end = i + window
    return covered


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Entropy of the ids in bits, over what their number allows; 1 for a single one."""
    n = len(ids)
    if n < 2:
        return 1.0
    _, counts = np.unique(ids, return_counts=True)
    p = counts / n
    return float(-(p * np.log2(p)).sum() / min(np.log2(n), ENTROPY_BITS))


def inside(band: Band, n_tokens: int, chars_per_token: float, byte_share: float, relative_entropy: float) -> bool:
    length = max(bisect_right(CLASSES, n_tokens) - 1, 0)
    return (
        band.chars_per_token[0] <= chars_per_token <= band.chars_per_token[1]
        and byte_share <= band.byte_share
        and relative_entropy >= band.entropy[length]
    )


_NEW = [
    ("n_words", pa.int64(), T.LongType()),
    ("word_chars", pa.int64(), T.LongType()),
    ("n_symbols", pa.int64(), T.LongType()),
    ("n_dup_lines", pa.int64(), T.LongType()),
    ("n_repeat_words", pa.int64(), T.LongType()),
    ("base_failed", pa.bool_(), T.BooleanType()),
    ("n_tokens", pa.int64(), T.LongType()),
    ("chars_per_token", pa.float64(), T.DoubleType()),
    ("byte_share", pa.float64(), T.DoubleType()),
    ("token_entropy", pa.float64(), T.DoubleType()),
    ("kept", pa.bool_(), T.BooleanType()),
]


def quality_rules(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns) and the counts, measures and verdict.

    A null text has no words. Texts that fail the plain rules are not encoded: their measures are
    null. Texts of fewer than ``MIN_TOKENS`` tokens that pass them are kept. A null or unlisted
    ``lang``, or a table without that column, is judged by script. Rows are judged one by
    one, so repeated rows get equal verdicts, and no column name clashes.
    """
    small_batches(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_bytes().alias("data"), lang.alias("lang")
    )
    schema = T.StructType(
        [T.StructField("row", source.schema["row"].dataType), *[T.StructField(n, t) for n, _, t in _NEW]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        drop_memos()
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        for incoming in batches:
            out: list[list] = [[] for _ in _NEW]
            for data, lang in zip(incoming.column(1).to_pylist(), incoming.column(2).to_pylist()):
                words = data.split()
                joined = b"".join(words)
                text = data.decode()
                repeats = repeated_words(words)
                failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
                counts = (
                    len(words),
                    len(joined.decode()),
                    len(data.translate(None, _OTHERS)),
                    repeated_lines(data),
                    repeats,
                    failed,
                )
                measures: tuple = (None, None, None, None)
                kept = not failed
                if kept:
                    ids = np.array(model.encode(text, num_threads=1))
                    measures = (len(ids), len(text) / len(ids), float(is_byte[ids].mean()), entropy(ids))
                    if len(ids) >= MIN_TOKENS:
                        band = LANGUAGES.get(lang) or SCRIPTS[script(text)]
                        kept = inside(band, *measures)
                for column, value in zip(out, (*counts, *measures, kept)):
                    column.append(value)
            arrays = [incoming.column(0), *[pa.array(c, t) for c, (_, t, _) in zip(out, _NEW)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", *[n for n, _, _ in _NEW]])

    return source.mapInArrow(run, schema)
