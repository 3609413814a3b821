"""Pure functions of the training-data operators against brute force."""

import collections
import gzip
import io
import random

import numpy as np
import public_tokenizers
import pytest

from aulario.llm import bitplanes, fertility, fingerprints, importance, packing, sentence_scan, suffix_dedup, warc
from aulario.llm.common import pieces_at_spaces, shingles
from aulario.llm.tokens import Encoder

ODD = ["a", "b", "é", "É", "中", "́", "0", "'s", "'", "!", ".", " ", " ", "\n", "\t", "\x1c", "\x85", "　", "İ", "Σ"]
ODD += ["<|endoftext|>", "<|startoftext|>", "\U0001f600", "\r", "​", "word", "THE"]


def odd_text(rng, n):
    return "".join(rng.choices(ODD, k=rng.randint(0, n)))


@pytest.mark.parametrize("name, words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoder_equals_the_library(name, words):
    rng = random.Random(1)
    encoder = Encoder(public_tokenizers.path(name), words)
    texts = [odd_text(rng, 16) for _ in range(2000)] + ["", "x" * 300, "the cat\nsat on the mat " * 50]
    for text, ids in zip(texts, encoder.encode_many([t.encode() for t in texts])):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_with_a_full_memo(monkeypatch):
    monkeypatch.setattr("aulario.llm.tokens.MEMO_PIECES", 5)
    monkeypatch.setattr("aulario.llm.tokens._SLICE", 3)
    rng = random.Random(2)
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), False)
    texts = [" ".join(rng.choices(["one", "two", "three", "four", "fünf", "six", "seven"], k=rng.randint(1, 30))) for _ in range(60)]
    for text, ids in zip(texts, encoder.encode_many([t.encode() for t in texts])):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_differencing_balances_and_pack_keeps_the_capacity():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 513, 400)
    windows = packing.differencing(lengths, 50)
    sums = np.bincount(windows, weights=lengths, minlength=50)
    assert sums.max() - sums.min() < 25
    windows = packing.pack(lengths, 2048)
    assert np.bincount(windows, weights=lengths).max() <= 2048
    assert windows.max() + 1 <= -(-lengths.sum() // 2048) + 2
    # Every pair exceeds the capacity, so the number of windows rises to one each.
    assert sorted(packing.pack(np.array([1500, 1500, 1500]), 2048)) == [0, 1, 2]


def test_cuts_cover_every_id_once():
    for total in (1, 511, 512, 513, 2047, 2048, 2049, 10_000):
        found = packing.cuts(total, 2048, 512)
        assert [i for a, n in found for i in range(a, a + n)] == list(range(total))
        assert all(n <= 512 or n == 2048 for _, n in found)


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (7, 2), (1000, 50_257), (64, 2**32), (5, 1 << 16)):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        assert (bitplanes.from_planes(bitplanes.to_planes(ids, planes), n, planes) == ids).all()


def test_plane_files_round_trip_over_chunk_edges():
    class Kept(io.BytesIO):
        def close(self):
            self.kept = self.getvalue()

    rng = np.random.default_rng(5)
    docs = [(None, np.array([0], np.uint32)), *[(i, rng.integers(0, 9999, rng.integers(0, 50)).astype(np.uint32)) for i in range(40)]]
    out = Kept()
    writer = bitplanes.PlaneWriter(out, block=64)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    read = [(d, [i for part in parts for i in part.tolist()]) for d, parts in bitplanes.PlaneReader(io.BytesIO(out.kept)).documents()]
    assert read == [(d, ids.tolist()) for d, ids in docs]
    with pytest.raises(ValueError):
        bitplanes.PlaneReader(io.BytesIO(out.kept[:-1]))


def test_records_skip_and_verify():
    parts = [
        warc.record(1, "http://a/\r\nX: y", "é\r\n\r\nWARC/1.1".encode(), False, None, "2020-01-01T00:00:00Z"),
        warc.record(2, None, "é\r\n\r\nWARC/1.1".encode(), True, 1, "2020-01-01T00:00:00Z"),
        warc.record(None, None, b"", False, None, "2020-01-01T00:00:00Z"),
    ]
    rows = list(warc.records(io.BytesIO(b"".join(parts)), "bytes"))
    assert [r[0] for r in rows] == [1, 2, None] and [r[2] for r in rows] == ["response", "revisit", "response"]
    assert rows[0][7] == "é\r\n\r\nWARC/1.1".encode() and rows[1][3] == len(rows[0][7]) and rows[1][5] == 1
    assert rows[0][1] == "http://a/ X: y" and rows[0][4] == rows[1][4]
    packed = b"".join(gzip.compress(p) for p in parts)
    assert [r[0] for r in warc.records(gzip.GzipFile(fileobj=io.BytesIO(packed)), wanted=lambda f: f["record_type"] == "revisit")] == [2]
    broken = parts[0].replace("é".encode(), b"zz")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(broken), "verify"))
    assert len(list(warc.records(io.BytesIO(broken), "skip"))) == 1


def test_repeats_by_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        words = [rng.choice(b"abc").to_bytes(1, "big") for _ in range(rng.randint(0, 40))]
        grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        marked = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert fertility.repeated_words(words) == len(marked)
    assert fertility.repeated_lines(b"a\n\na\n \n \nb\na") == 2


def test_fertility_measures():
    assert fertility.entropy(np.array([5])) == 1.0
    assert fertility.entropy(np.array([1, 1, 1, 1])) == 0.0
    assert fertility.entropy(np.arange(16)) == pytest.approx(1.0)
    assert fertility.script("Привет мир") == "other" and fertility.script("abc 123") == "latin" and fertility.script("") == "latin"


def test_fingerprints_estimate_jaccard():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    for share in (0.0, 0.5, 0.9, 1.0):
        base = [rng.choice(words) for _ in range(2000)]
        other = base[: int(2000 * share)] + [rng.choice(words) for _ in range(2000 - int(2000 * share))]
        a, b = shingles(" ".join(base).encode()), shingles(" ".join(other).encode())
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - true) < 0.12
    one = fingerprints.fingerprint(shingles(b"only two"))
    assert len(one) == fingerprints.BINS and fingerprints.likeness(one, one) == 1.0
    assert fingerprints.likeness(b"", b"") == 1.0 and fingerprints.likeness(b"", one) == 0.0
    assert fingerprints.edited("abcdefgh", "XYZ") == "abcdefXY" and fingerprints.edited("abcdefgh", "X") == "abcdefX"


def test_gram_buckets_do_not_depend_on_slices(monkeypatch):
    data = ("The cat, sat! on the mat " * 30).encode()
    whole = np.sort(np.concatenate(list(importance.gram_buckets(data))))
    monkeypatch.setattr(importance, "_BLOCK", 10)
    assert (np.sort(np.concatenate(list(importance.gram_buckets(data)))) == whole).all()
    assert list(importance.gram_buckets(b"")) == [] and list(importance.gram_buckets(b" \n")) == []


def test_pieces_at_spaces_lose_nothing():
    data = b"ab cd  efghij\nk" * 20
    parts = list(pieces_at_spaces(data, 7))
    assert b"".join(parts) == data and b" ".join(parts).split() == data.split()


@pytest.fixture(scope="module")
def vocabulary():
    return sentence_scan.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def brute_best(v, s):
    best = [0.0] + [-np.inf] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - v.longest), j):
            found = v.pieces.get(s[i:j])
            score = found[0] if found else (v.unknown if j == i + 1 else None)
            if score is not None:
                best[j] = max(best[j], best[i] + score)
    return best[-1]


def test_paths_are_best_and_decode(vocabulary):
    rng = random.Random(8)
    for _ in range(400):
        text = odd_text(rng, 20).replace("▁", "")
        s = vocabulary.normalize(text)
        assert s == vocabulary.model.normalize(text)
        score, ids = vocabulary.encode(s)
        assert score == brute_best(vocabulary, s)
        assert vocabulary.decode(ids) == vocabulary.model.decode(ids)
        assert vocabulary.decode(ids) == text.replace("▁", " ")


def test_ids_are_those_of_the_unigram_library(vocabulary):
    rng = random.Random(10)
    for _ in range(400):
        s = vocabulary.normalize(odd_text(rng, 20))[:160]
        ids = vocabulary.library.encode(s)
        assert ids == vocabulary.path(s, 0, len(s)) == vocabulary.encode(s)[1]


def test_words_are_forgotten_when_there_are_too_many(vocabulary, monkeypatch):
    monkeypatch.setattr(sentence_scan, "MEMO_UNITS", 50)
    rng = random.Random(11)
    for _ in range(60):
        s = vocabulary.normalize(odd_text(rng, 30) + "x" * rng.choice([0, 200]))
        assert vocabulary.encode(s)[1] == vocabulary.path(s, 0, len(s))


def test_chunks_reach_the_same_ids(vocabulary):
    rng = random.Random(9)
    odd = [odd_text(rng, 60) * 3 for _ in range(60)]
    same = ["".join(rng.choice(["a", "aa", "e", "i", "n", "in"]) for _ in range(150)) for _ in range(30)]
    for text in [*odd, *same, "abcde" * 60, "   " * 50, "interesting" * 30, "a" * 300, "漢字かな" * 80, "0" * 90 + "=" * 90]:
        s = vocabulary.normalize(text)
        whole = vocabulary.path(s, 0, len(s))
        for chunk in (17, 18, 40, 101):
            if not s:
                continue
            parts = [(s[a : a + chunk + vocabulary.longest - 1], min(chunk, len(s) - a)) for a in range(0, len(s), chunk)]
            matrices = [vocabulary.transfer(p, n) for p, n in parts]
            between = sentence_scan.states(matrices, 0, 0)
            ids, entry = [], 0
            for (p, n), exit_ in zip(parts, between):
                head, words, tail = vocabulary.trace(p, n, entry, exit_)
                ids += head + vocabulary.encode(words)[1] + tail
                entry = exit_
            assert ids == whole
            left, right = matrices[0], matrices[-1]
            for m in matrices[1:]:
                left = sentence_scan.times(left, m)
            for m in reversed(matrices[:-1]):
                right = sentence_scan.times(m, right)
            total = brute_best(vocabulary, s)
            assert sentence_scan.full(left)[0][0, 0] == sentence_scan.full(right)[0][0, 0] == total
            # Products of neighbours in a tree lead to the same states.
            pairs = [sentence_scan.times(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
            assert sentence_scan.states(pairs, 0, 0)[:-1] == between[1:-1:2][: len(pairs) - 1]


def test_matrices_survive_their_bytes(vocabulary):
    for s in ("interesting words in a row", "a" * 40):
        m = vocabulary.transfer(vocabulary.normalize(s), 20)
        assert np.array_equal(sentence_scan._matrix(sentence_scan._bytes(m)), m)


def test_scan_runs_cover_every_window_once():
    rng = random.Random(10)
    pieces = [bytes(rng.choices(b"ab", k=n)) for n in (0, 99, 100, 101, 500)] + [b"a" * 300, b"abcab" * 80]
    scan = suffix_dedup.Scan(pieces, 100, 25)
    starts = np.r_[0, scan.ends[:-1]]
    covered = sorted((int(p), int(i - starts[p])) for p, a, b in zip(scan.piece, scan.first, scan.last) for i in range(a, b + 1))
    assert covered == [(k, i) for k, p in enumerate(pieces) for i in range(len(p) - 99)]


def test_cut_scans_texts_once(monkeypatch):
    rng = random.Random(11)
    texts = [bytes(rng.choices(range(97, 123), k=n)) for n in (0, 90, 700, 3000)]
    scanned = []

    class Counted(suffix_dedup.Scan):
        def __init__(self, pieces, length, q):
            scanned.extend(map(len, pieces))
            super().__init__(pieces, length, q)

    runs = [suffix_dedup.Scan([t], 100, 25).run.view(np.int64).tolist() for t in texts]
    nothing = [None] * len(texts)
    monkeypatch.setattr(suffix_dedup, "Scan", Counted)
    # All runs are listed for refinement, but no text has two of one bucket.
    assert not any(gone.any() for gone in suffix_dedup.repeated(texts, nothing, runs, nothing, 100, 25))
    assert sum(scanned) == sum(map(len, texts))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_sweep_goes_on_over_calls(size):
    rng = random.Random(12)
    passage = bytes(rng.choices(range(97, 123), k=160))
    runs = sorted((g, rng.randint(1, 9), i) for g in (-5, 3, 8) for i in range(40))
    content = {i: passage[(a := rng.randint(0, 60)) : a + rng.randint(100, 160)] for i in range(40)}
    content |= {i: content[i][:50] + b"!" + content[i][51:] for i in range(0, 40, 3)}
    expected, first = set(), {}
    for n, (g, doc, i) in enumerate(runs):
        for o in range(len(content[i]) - 99):
            if first.setdefault((g, content[i][o : o + 100]), doc) < doc:
                expected.add((n, o))
    sweep, found = suffix_dedup.Sweep(100, 25), set()
    for a in range(0, len(runs), size):
        part = runs[a : a + size]
        g, doc = (np.array([r[k] for r in part], np.int64) for k in (0, 1))
        for n, lo, hi in zip(*sweep.late(g, doc, [content[r[2]] for r in part])):
            found |= {(a + int(n), o) for o in range(lo, hi + 1)}
    assert found == expected and expected
