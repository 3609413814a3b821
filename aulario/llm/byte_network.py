"""Language identification by a small convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one aligned with the end of the
text. Bytes are embedded, filters of several widths run over a window, each filter keeps its largest
response (max pooling), and a softmax layer turns the responses into language probabilities. A text's
log probabilities are the mean of its windows', weighted by the bytes that each window adds.

The network is trained in numpy, with Adam, on windows of a bounded sample of labelled texts: at most
``PER_LANGUAGE`` texts for each of at most ``LANGUAGES`` languages, and ``PER_TEXT`` windows of a text.
Scoring is one narrow pass over all texts, in batches of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulario.llm.common import batch, small_batches, staged, text_bytes

UNKNOWN = "und"
WINDOW = 128
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
EMBEDDING = 8
PER_LANGUAGE = 500
LANGUAGES = 200
PER_TEXT = 6
EPOCHS = 12
_MINIBATCH = 64
_BLOCK = 256
# A-Z in lower case, digits alike, control characters as spaces; 0 stands for no byte.
_FOLD = bytes(
    0x20 if b < 0x20 or b == 0x7F else 0x30 if 0x30 <= b <= 0x39 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def windows(data: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows, bytes that each adds) of a text; a text shorter than a window is padded with zeros."""
    flat = np.frombuffer(data.translate(_FOLD), np.uint8)
    n = len(flat)
    if n < size:
        return np.pad(flat, (0, size - n))[None, :], np.array([n], np.float64)
    full = flat[: n - n % size].reshape(-1, size)
    adds = np.full(len(full), float(size))
    if n % size:
        full, adds = np.vstack([full, flat[None, n - size :]]), np.r_[adds, float(n % size)]
    return full, adds


@dataclass
class ByteNetwork:
    """Weights of the network; ``languages`` in the order of its outputs."""

    languages: list[str]
    window: int = WINDOW
    widths: tuple[int, ...] = WIDTHS
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator, window: int, widths: tuple[int, ...], filters: int, embedding: int) -> ByteNetwork:
        new = cls(languages, window, tuple(widths))
        w = {"bytes": rng.normal(0, 0.5, (256, embedding)), "out": rng.normal(0, 0.1, (filters * len(widths), len(languages)))}
        w["bytes"][0] = 0.0
        w["out0"] = np.zeros(len(languages))
        for k in widths:
            w[f"conv{k}"] = rng.normal(0, (2.0 / (k * embedding)) ** 0.5, (k * embedding, filters))
            w[f"bias{k}"] = np.zeros(filters)
        new.weights = {name: value.astype(np.float32) for name, value in w.items()}
        return new

    def _patches(self, ids: np.ndarray) -> np.ndarray:
        """What the widest filter sees at each place: (windows, places, width x embedding)."""
        longest = max(self.widths)
        x = self.weights["bytes"][np.pad(ids, ((0, 0), (0, longest - 1)))]
        seen = np.lib.stride_tricks.sliding_window_view(x, longest, axis=1).transpose(0, 1, 3, 2)
        return seen.reshape(len(ids), ids.shape[1], -1)

    def _responses(self, patches: np.ndarray, k: int) -> np.ndarray:
        w = self.weights[f"conv{k}"]
        flat = patches.reshape(-1, patches.shape[2])[:, : len(w)]
        return (flat @ w).reshape(*patches.shape[:2], -1)

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        patches = self._patches(ids)
        pooled = [self._responses(patches, k).max(axis=1) + self.weights[f"bias{k}"] for k in self.widths]
        z = np.maximum(np.hstack(pooled), 0) @ self.weights["out"] + self.weights["out0"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, ids: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of windows with their languages, and its gradient for every weight."""
        w, n = self.weights, len(ids)
        patches = self._patches(ids)
        rows = np.arange(n)[:, None]
        pooled, places = [], []
        for k in self.widths:
            z = self._responses(patches, k)
            at = z.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0] + w[f"bias{k}"])
        hidden = np.maximum(np.hstack(pooled), 0)
        z = hidden @ w["out"] + w["out0"]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        loss = -float(np.log(np.maximum(p[np.arange(n), wanted], 1e-30)).mean())
        p[np.arange(n), wanted] -= 1
        p /= n
        out = {"out": hidden.T @ p, "out0": p.sum(axis=0), "bytes": np.zeros_like(w["bytes"])}
        back = (p @ w["out"].T) * (hidden > 0)
        padded = np.pad(ids, ((0, 0), (0, max(self.widths) - 1)))
        for i, (k, at) in enumerate(zip(self.widths, places)):
            conv = w[f"conv{k}"]
            g = np.split(back, len(self.widths), axis=1)[i]
            # Only the place with the largest response passes its gradient on.
            out[f"conv{k}"] = np.einsum("nf,nfc->cf", g, patches[rows, at][:, :, : len(conv)])
            out[f"bias{k}"] = g.sum(axis=0)
            into = (g[:, :, None] * conv.T[None]).reshape(*g.shape, k, -1)
            np.add.at(out["bytes"], padded[rows[:, :, None], at[:, :, None] + np.arange(k)], into)
        out["bytes"][0] = 0.0
        return loss, out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Mean log probabilities of each text (rows) per language; texts must not be empty."""
        total = np.zeros((len(texts), len(self.languages)))
        weight = np.zeros(len(texts))
        parts: list[tuple[np.ndarray, np.ndarray, int]] = []
        waiting = 0

        def settle() -> None:
            nonlocal parts, waiting
            ids = np.concatenate([p for p, _, _ in parts])
            adds = np.concatenate([a for _, a, _ in parts])
            who = np.repeat([i for _, _, i in parts], [len(a) for _, a, _ in parts])
            found = self.log_probabilities(ids) * adds[:, None]
            for j in range(found.shape[1]):
                total[:, j] += np.bincount(who, found[:, j], len(texts))
            weight[:] += np.bincount(who, adds, len(texts))
            parts, waiting = [], 0

        for i, data in enumerate(texts):
            ids, adds = windows(data, self.window)
            for at in range(0, len(ids), _BLOCK):
                parts.append((ids[at : at + _BLOCK], adds[at : at + _BLOCK], i))
                waiting += len(parts[-1][1])
                if waiting >= _BLOCK:
                    settle()
        if parts:
            settle()
        return total / np.maximum(weight, 1.0)[:, None]


def train(
    samples: list[tuple[str, bytes]],
    epochs: int = EPOCHS,
    window: int = WINDOW,
    widths: tuple[int, ...] = WIDTHS,
    filters: int = FILTERS,
    embedding: int = EMBEDDING,
    per_text: int = PER_TEXT,
    rate: float = 0.003,
    seed: int = 5,
) -> ByteNetwork | None:
    """Network from (language, text) pairs; None without any. Languages weigh alike, and a third of the windows is cut short."""
    rng = np.random.default_rng(seed)
    names = sorted({lang for lang, _ in samples})
    if not names:
        return None
    ids, wanted = [], []
    for lang, data in samples:
        found, _ = windows(data, window)
        some = found[np.unique(np.linspace(0, len(found) - 1, per_text).astype(int))]
        ids.append(some)
        wanted += [names.index(lang)] * len(some)
    x, y = np.concatenate(ids), np.array(wanted)
    net = ByteNetwork.fresh(names, rng, window, widths, filters, embedding)
    share = 1.0 / np.bincount(y, minlength=len(names))[y]
    first = {name: np.zeros_like(v) for name, v in net.weights.items()}
    second = {name: np.zeros_like(v) for name, v in net.weights.items()}
    step, steps = 0, epochs * -(-len(x) // _MINIBATCH)
    for _ in range(epochs):
        drawn = rng.choice(len(x), len(x), p=share / share.sum())
        for at in range(0, len(drawn), _MINIBATCH):
            some = drawn[at : at + _MINIBATCH]
            ids_now = x[some].copy()
            short = rng.random(len(some)) < 1 / 3
            ends = np.where(short, rng.integers(12, window + 1, len(some)), window)
            ids_now[np.arange(window)[None, :] >= ends[:, None]] = 0
            _, grads = net.gradients(ids_now, y[some])
            step += 1
            now = rate * (1 - (step - 1) / steps)
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                a, b = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                net.weights[name] -= (now * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: CRC-32 of the id as text leaves 1 modulo 3 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def labelled_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> list[tuple[str, bytes]]:
    """Distinct labelled texts to learn from: per language those with the lowest hashes.

    At most ``per_language`` texts for each of the ``languages`` most frequent ones, however often a text is repeated.
    """
    lang = F.col("lang").cast("string")
    known = docs.filter(lang.isNotNull() & has_letter(F.col("text")) & ~held_out(F.col("doc_id")))
    hashed = known.select(lang.alias("lang"), F.xxhash64(text_bytes()).alias("th"), F.col("text").cast("string").alias("text"))
    most = hashed.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("th"))
    keys = hashed.select("lang", "th").distinct().join(F.broadcast(most), "lang", "left_semi")
    keys = staged(keys.withColumn("_place", place).filter(F.col("_place") <= per_language).drop("_place"), "sample")
    texts = hashed.join(F.broadcast(keys), ["lang", "th"]).groupBy("lang", "th").agg(F.min("text").alias("text"))
    return [(r[0], r[2].encode()) for r in sorted(texts.collect(), key=lambda r: (r[0], r[1]))]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES, **options) -> ByteNetwork | None:
    """Network learnt from the labelled rows of ``docs`` (``doc_id, text, lang``) that are not held out; None without any."""
    small_batches(docs.sparkSession)
    return train(labelled_sample(docs, per_language, languages), **options)


def predict(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score``, from the whole text alone.

    ``score`` is the probability of the language. Null texts, texts without a letter, and all texts if there is no
    network, are ``und`` with score 0. Rows with a null or repeated ``doc_id`` are rows like any other; an empty table gives
    no rows; columns other than ``doc_id`` and ``text`` are not read. Very long texts are many windows, worked on in blocks.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            n = incoming.num_rows
            names, probabilities = [UNKNOWN] * n, [0.0] * n
            texts, letters = incoming.column(2).to_pylist(), incoming.column(3).to_pylist()
            who = [i for i in range(n) if letters[i] and net is not None]
            if who:
                found = net.scores([texts[i] for i in who])
                best = found.argmax(axis=1)
                share = np.exp(found - found.max(axis=1, keepdims=True))
                share = share.max(axis=1) / share.sum(axis=1)
                for i, b, p in zip(who, best, share):
                    names[i], probabilities[i] = net.languages[b], float(p)
            yield batch(_SCORED, [incoming.column(0), incoming.column(1), names, probabilities])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        text_bytes().alias("data"),
        has_letter(F.col("text")).alias("letter"),
    )
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
