"""Byte network, target resampling and spelling groups: brute force, held-out accuracy, odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from aulario.llm import byte_network, spelling_groups, target_resampling
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Byte network


def test_windows_cover_every_byte_once():
    for n in (0, 1, 127, 128, 129, 1000):
        found, adds = byte_network.windows(b"x" * n, 128)
        assert found.shape == (len(adds), 128) and adds.sum() == n
        assert int((found > 0).sum()) >= n


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = byte_network.ByteNetwork.fresh(["a", "b", "c"], rng, 16, (2, 3), 4, 3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    ids, wanted = rng.integers(97, 105, (5, 16)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(ids, wanted)
    for name, weight in net.weights.items():
        at = (100, 1) if name == "bytes" else tuple(0 for _ in weight.shape)
        step = 1e-5
        weight[at] += step
        up = net.gradients(ids, wanted)[0]
        weight[at] -= 2 * step
        down = net.gradients(ids, wanted)[0]
        weight[at] += step
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_filters_of_every_width_and_pooling():
    rng = np.random.default_rng(1)
    net = byte_network.ByteNetwork.fresh(["a", "b"], rng, 12, (2, 4), 3, 5)
    ids = rng.integers(1, 255, (3, 12)).astype(np.uint8)
    found = net.log_probabilities(ids)
    for row, got in zip(ids, found):
        hidden = []
        padded = np.r_[row, np.zeros(3, np.uint8)]
        for k in net.widths:
            for f in range(3):
                best = max(
                    sum(float(net.weights["bytes"][padded[t + j]] @ net.weights[f"conv{k}"][j * 5 : j * 5 + 5, f]) for j in range(k))
                    for t in range(12)
                )
                hidden.append(max(best + float(net.weights[f"bias{k}"][f]), 0.0))
        z = np.array(hidden) @ net.weights["out"] + net.weights["out0"]
        want = z - np.log(np.exp(z).sum())
        assert np.allclose(got, want, atol=1e-4)


def test_long_text_equals_mean_of_its_windows():
    rng = np.random.default_rng(2)
    net = byte_network.ByteNetwork.fresh(["a", "b"], rng, 128, (2, 3), 3, 5)
    text = bytes(rng.integers(97, 123, 128 * 700 + 50).astype(np.uint8))
    ids, adds = byte_network.windows(text)
    want = (net.log_probabilities(ids) * adds[:, None]).sum(axis=0) / adds.sum()
    assert np.allclose(net.scores([b"abc", text])[1], want, atol=1e-4)


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = byte_network.predict(docs, byte_network.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    asked = [r for r in found if r.held_out and r.lang is not None and r.lang_pred != "und"]
    assert len(asked) > 40
    assert sum(r.lang == r.lang_pred for r in asked) >= 0.95 * len(asked)


def test_network_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score double, lang_pred string"
    odd = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (None, "der Hund und die Katze", None), (5, "the dog", "en"), (5, "the dog", "en")]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in odd], schema)
    some = [(i, "the cat sat on the mat and the dog ran" if i % 2 else "der Hund und die Katze sind nicht hier", "en" if i % 2 else "de", 0.0, "") for i in range(10, 60)]
    net = byte_network.fit(spark.createDataFrame(some, schema), epochs=300)
    found = {(r.doc_id, r.lang_pred): r.score for r in byte_network.predict(docs, net).collect()}
    assert {k for k, p in found.items() if p == 0} == {(1, "und"), (2, "und"), (3, "und")}
    assert (5, "en") in found and (None, "de") in found
    assert byte_network.predict(docs.limit(0), net).count() == 0
    assert byte_network.fit(docs.filter("lang is null")) is None
    assert {r.lang_pred for r in byte_network.predict(docs, None).collect()} == {"und"}


def test_sample_is_bounded_under_repeated_texts(spark):
    data = [(i, "the same words again", "en") for i in range(500)] + [(i, f"text number {i}", "en") for i in range(500, 600)]
    data += [(i, "autre chose", "fr") for i in range(600, 610)] + [(i, "rare", f"l{i}") for i in range(610, 640)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = byte_network.labelled_sample(docs, per_language=20, languages=2)
    assert collections.Counter(lang for lang, _ in found) == {"en": 20, "fr": 1}
    assert len(set(found)) == len(found)


# Target resampling


def plain_resample(docs, target, percent=10, min_words=20, longest=1, buckets=10_000, seed=2024):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text or ""))
        found = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in found]

    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * float(S + buckets) / ((s[b] + 1) * float(T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def odd_docs(n=300, seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "día", "x1", "x-y", "中文", "¿qué?", "a_b", "É", "--", "12"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(1000, None), (1001, ""), (1002, " \n\t"), (None, "the cat " * 30), (7, "the cat " * 30), (7, "the cat " * 30), (7, "the cat " * 30)]
    return docs + [(1003, "the cat sat " * 1000), (2000, "w" * 5000)]


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 50), (2, 100), (1, 0)])
def test_resampling_equals_brute_force(spark, longest, percent):
    docs, target = odd_docs(), ["the cat día", None, "", "x1 x1 中文 the"]
    df = spark.createDataFrame([(*d, 9, "k") for d in docs], "doc_id long, text string, rank long, weight string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = target_resampling.resample_to_target(df, goal, percent=percent, longest=longest, accuracy=20, bracket=8)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(found) == plain_resample(docs, target, percent, longest=longest)


def test_resampling_of_long_texts_in_slices(monkeypatch):
    known = target_resampling._Buckets(10_000)
    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    whole = list(target_resampling.feature_buckets(text, 3, known))
    monkeypatch.setattr(target_resampling, "pieces_at_spaces", lambda data: __import__("aulario.llm.common", fromlist=["x"]).pieces_at_spaces(data, 50))
    parts = list(target_resampling.feature_buckets(text, 3, known))
    assert len(whole) == 1 and len(parts) > 100
    assert sum(n for n, _ in parts) == whole[0][0] == 5000
    assert collections.Counter(np.concatenate([b for _, b in parts]).tolist()) == collections.Counter(whole[0][1].tolist())


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame(odd_docs(20), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert target_resampling.resample_to_target(none, docs).count() == 0
    assert rows(target_resampling.resample_to_target(docs, none)) == plain_resample(odd_docs(20), [])


@pytest.mark.parametrize("kind", ["spread", "few", "one", "hot"])
def test_value_at_any_place(spark, kind):
    rng = random.Random(4)
    data = {
        "spread": [rng.randint(-(10**12), 10**12) for _ in range(3000)],
        "few": [rng.choice([1, 2, 2, 2, 900]) for _ in range(3000)],
        "one": [5] * 3000,
        "hot": [7] * 1500 + [rng.randint(0, 20) for _ in range(1500)],
    }[kind]
    df = spark.createDataFrame([(x,) for x in data], "x long").repartition(5).cache()
    data.sort()
    for k in (1, 2, 1499, 1500, 1501, 2999, 3000):
        value = data[k - 1]
        want = (value, sum(x < value for x in data), data.count(value))
        assert target_resampling.value_at(df, "x", k, accuracy=20, bracket=10) == want


# Spelling groups


def plain_groups(docs, every=199, min_length=6, min_count=5, ratio=5):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = [], {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
        out.append([w, words[w], form[w], None, len(near), words[form[w]] if form[w] else None])
    for r in out:
        root = r[0]
        while form[root]:
            root = form[root]
        r[3] = root
    return sorted((tuple(r) for r in out), key=repr)


def letters(rng, kind):
    if kind == "anagrams":  # one point holds very many words
        return "".join(rng.sample("abcdefgh", 8)) if rng.random() < 0.7 else "".join(rng.choices("abcdefgh", k=rng.randint(7, 9)))
    if kind == "doubled":
        return "".join(rng.choices("ab", k=rng.randint(6, 9)))
    return "".join(rng.choices("aeénÿ×T", k=rng.randint(5, 8)))


@pytest.mark.parametrize("kind", ["anagrams", "doubled", "accents"])
def test_groups_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    vocabulary = [letters(rng, kind) for _ in range(250)]
    for w in vocabulary[:120]:
        at = rng.randrange(len(w))
        vocabulary.append(w[:at] + rng.choice(["", "a", "bb"]) + w[at + 1 :])
    weights = [rng.choice([1, 1, 6, 40]) for _ in vocabulary]
    docs = [(rng.choice([None, i, i % 5]), " ".join(rng.choices(vocabulary, weights, k=60)) + ", 9!") for i in range(120)]
    docs += [(5, None), (6, ""), (7, "123 --")]
    df = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n long")
    for limits in ({}, {"cell": 8, "sample": 100}, {"cell": 4, "sample": 5}):
        found = spelling_groups.spelling_groups(df, every=7, min_count=2, ratio=2, **limits)
        assert rows(found, "word", "n", "form", "root", "n_near", "form_n") == plain_groups(docs, 7, 6, 2, 2)


def test_groups_of_long_words(spark):
    rng = random.Random(9)
    base = ["".join(rng.choices("abc", k=n)) for n in (63, 64, 65, 66, 300, 5000)]
    words = []
    for w in base:
        words += [w] * 12
        for at in (0, len(w) // 2, len(w) - 1):
            words += [w[:at] + w[at + 1 :]] * 2 + [w[:at] + "d" + w[at + 1 :]] * 2 + [w[:at] + "e" + w[at:]] * 2
    docs = [(i, w) for i, w in enumerate(words)]
    found = spelling_groups.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"), every=10**9, min_count=2, cell=3)
    assert rows(found, "word", "n", "form", "root", "n_near", "form_n") == plain_groups(docs, 10**9, 6, 2, 5)


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_groups.spelling_groups(empty).count() == 0


def test_runs_across_slices(monkeypatch):
    rng = random.Random(10)
    text = "".join(rng.choices("abÀ× 1", k=3000)) + "z" * 200 + " end"
    for size in (7, 64, 1000):
        monkeypatch.setattr(spelling_groups, "_SLICE", size)
        assert list(spelling_groups.runs(text)) == re.findall("[A-Za-zÀ-ÿ]+", text)


def test_cells_and_tree_equal_plain_distances():
    rng = np.random.default_rng(11)
    points = rng.integers(0, 3, (400, len(spelling_groups.LETTERS))).astype(np.int32)
    points[:, 6:] = 0
    cells = spelling_groups.Cells(points[:200], 16)
    assert cells.count > 8
    home = cells.home(points)
    apart = np.abs(points[:, None] - points[None]).sum(axis=2)
    for radius in (1, 2):
        sent = {(int(q), cell) for cell, who in cells.within(points, radius) for q in who}
        assert all((int(q), int(home[p])) in sent for q, p in zip(*np.nonzero(apart <= radius)))
        found = {(int(q), int(p)) for qs, ps in spelling_groups.Tree(points).at_distance(points, radius) for q, p in zip(qs, ps)}
        assert found == set(map(tuple, np.argwhere(apart == radius).tolist()))
