"""Encoding with the tokenizers library, one call per distinct piece of text and worker.

Both vocabularies split text before they merge, so a piece between two safe cuts has the same
ids wherever it stands. Distinct pieces are far fewer than pieces; each worker remembers the
ids of what it has encoded, in a bounded table, and gathers a text's ids from there.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

from aulario.llm.common import MEMORIES

# Fixed value: strings of the special tokens of the two vocabularies.
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
# What makes a space an unsafe cut for the byte-level vocabulary: white space other than single
# spaces and line feeds between other characters, and control characters on which regular
# expression libraries disagree.
_UNSAFE = (
    *("  ", " \n", "\n ", "\n\n"),
    *map(chr, (*range(9, 10), *range(11, 14), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680)),
    *map(chr, (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)),
)
# Pieces remembered per worker (some 150 bytes each), and pieces looked up at once.
MEMO_PIECES = 1_000_000
_SLICE = 200_000
_CALL = 128


class _Memo(dict):
    """Piece -> number; unknown pieces get the next number and are noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, piece):
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


def _utf8_lengths(tokenizer) -> np.ndarray:
    """Bytes of text behind each id; 0 for special tokens."""
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    out = np.zeros(size, np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        # A byte-level vocabulary writes every byte as one character.
        out[i] = len(token.removesuffix("</w>"))
    for token in SPECIAL:
        i = tokenizer.token_to_id(token)
        if i is not None:
            out[i] = 0
    return out


class Encoder:
    """Ids of whole texts as arrays of unsigned 32-bit numbers.

    ``words`` is for vocabularies that drop white space and letter case: any ASCII white space is
    a cut. Otherwise the cuts are single spaces (which belong to the following piece) and
    single line feeds; texts with other white space or special tokens are encoded in one call.
    """

    def __init__(self, path: str, words: bool, pieces: int | None = None) -> None:
        self.pieces = MEMO_PIECES if pieces is None else pieces
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = words
        self.lengths = _utf8_lengths(self.tokenizer)
        self._empty()

    def _empty(self) -> None:
        self.memo = _Memo()
        self.starts = np.zeros(1 << 16, np.int64)
        self.counts = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0
        self.known = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _store(self, numbers: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        top = int(numbers.max()) + 1
        while top > len(self.starts):
            self.starts = np.r_[self.starts, np.zeros_like(self.starts)]
            self.counts = np.r_[self.counts, np.zeros_like(self.counts)]
        while self.used + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(counts) - counts
        self.counts[numbers] = counts
        self.used += len(ids)

    def _joinable(self, piece) -> bool:
        """Whether the piece may share a call: its ids are told from their text's length."""
        if not self.words:
            return piece != "" and piece != "\n" and len(piece) <= 64
        if len(piece) > 64 or b"<|" in piece:
            return False
        if piece.isascii():
            return True
        text = piece.decode()
        return unicodedata.is_normalized("NFC", text) and len(text.lower().encode()) == len(piece) and not any(map(str.isspace, text))

    def _learn(self) -> None:
        new, base = self.memo.new, self.known
        self.memo.new, self.known = [], len(self.memo)
        groups: dict[bool, list] = {False: [], True: []}
        for number, piece in enumerate(new, base):
            if self._joinable(piece):
                groups[not self.words and piece[0] == " "].append((number, piece))
            else:
                ids = self.whole(piece.decode() if self.words else piece)
                self._store(np.array([number]), np.array([len(ids)]), ids)
        for spaced, pieces in groups.items():
            calls = [pieces[i : i + _CALL] for i in range(0, len(pieces), _CALL)]
            # Words are parted by spaces that leave no ids, first words of lines by line feeds.
            if self.words:
                texts = [b" ".join([p for _, p in c]).decode() for c in calls]
            else:
                texts = [("" if spaced else "\n").join([p for _, p in c]) for c in calls]
            for call, found in zip(calls, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(found.ids, np.uint32)
                sizes = np.array([len(p) if self.words else len(p.encode()) for _, p in call])
                ends = np.cumsum(sizes)
                if not self.words and not spaced:
                    ends += np.arange(len(call))
                at = np.cumsum(self.lengths[ids])
                last = np.searchsorted(at, ends)
                if len(ids) == 0 or last[-1] != len(ids) - 1 or (at[last] != ends).any():
                    for number, piece in call:
                        one = self.whole(piece.decode() if self.words else piece)
                        self._store(np.array([number]), np.array([len(one)]), one)
                    continue
                counts = np.diff(last, prepend=-1)
                if not self.words and not spaced:
                    keep = np.ones(len(ids), bool)
                    keep[last[:-1] + 1] = False  # the line feeds
                    ids = ids[keep]
                    counts[1:] -= 1
                self._store(np.array([n for n, _ in call]), counts, ids)

    def _cut(self, data: bytes) -> list | None:
        if self.words:
            return data.split() if b"<|" in data else data.lower().split()
        text = data.decode()
        if not text or text[0] in " \n" or text[-1] in " \n" or any(s in text for s in (*_UNSAFE, *SPECIAL)):
            return None
        units: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                units.append("\n")
            first, *rest = line.split(" ")
            units.append(first)
            units += [" " + w for w in rest]
        return units

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        counts = self.counts[numbers].astype(np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[numbers] - ends + counts, counts) + np.arange(total)]

    def encode_many(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text (UTF-8), in order."""
        waiting: list[list[np.ndarray]] = []
        pieces = 0

        def flush() -> Iterator[np.ndarray]:
            nonlocal waiting, pieces
            if self.memo.new:
                self._learn()
            for parts in waiting:
                ready = [self._gather(p) if p.dtype == np.int64 else p for p in parts]
                yield ready[0] if len(ready) == 1 else np.concatenate([np.zeros(0, np.uint32), *ready])
            waiting, pieces = [], 0

        for data in texts:
            units = self._cut(data)
            if units is None:
                waiting.append([self.whole(data.decode())])
                continue
            parts: list[np.ndarray] = []
            waiting.append(parts)
            for i in range(0, len(units), _SLICE):
                part = units[i : i + _SLICE]
                if pieces + len(part) > 4 * _SLICE or len(self.memo) + len(part) > self.pieces + 4 * _SLICE:
                    # Settle what is open; the text at hand is carried on afterwards.
                    waiting.pop()
                    yield from flush()
                    parts[:] = [self._gather(p) if p.dtype == np.int64 else p for p in parts]
                    if len(self.memo) > self.pieces:
                        self._empty()
                    waiting.append(parts)
                parts.append(np.fromiter(map(self.memo.__getitem__, part), np.int64, len(part)))
                pieces += len(part)
        yield from flush()
        if len(self.memo) > self.pieces:
            self._empty()

    def encode(self, data: bytes) -> np.ndarray:
        return next(self.encode_many([data]))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}
MEMORIES["encoders"] = _ENCODERS.clear


def encoder(path: str, words: bool, pieces: int | None = None) -> Encoder:
    """The worker's encoder of a vocabulary file, which remembers ``pieces`` pieces."""
    key = (path, words)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, words, pieces)
    return _ENCODERS[key]
