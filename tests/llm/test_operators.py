"""Training-data operators on small tables with awkward rows, and their queries against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from aulario.llm import (
    bitplanes,
    compression_toxicity,
    fertility,
    fingerprints,
    importance,
    ngram_join,
    packing,
    queries,
    sentence_scan,
    suffix_dedup,
    warc,
)
from aulario.llm.common import new_folder, shingles

SF_DIR = os.environ.get("AULARIO_SF_DIR", "/root/testdata/sf0.001")
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
# Extra columns named like the operators' own.
DOCS = "doc_id long, text string, lang string, n_tokens string, row int, data string, th string, sig int, kept string, c int"


def sentence(rng, n):
    return " ".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 7))) for _ in range(n))


def awkward_rows():
    rng = random.Random(1)
    base = sentence(rng, 200)
    near = base.split()
    near[100] = "changed"
    long = sentence(rng, 30_000)
    texts = [
        (5, base), (3, base), (9, " ".join(near)), (4, None), (8, ""), (7, " \n\t "), (11, "one two"), (12, "ONE TWO"),
        (13, long), (14, sentence(rng, 50) + "\n" + base + "\n" + sentence(rng, 50)), (None, base), (None, sentence(rng, 60)),
        (20, sentence(rng, 80)), (20, sentence(rng, 80)), (21, "dup dup dup dup dup dup dup dup dup dup dup dup"),
        (22, "é中 \U0001f600 " * 40), (2, "x" * 5000), (23, base.upper()),
    ]
    texts += [(21, texts[14][1])]
    return [(i, t, "en", "x", 1, "x", "x", 1, "x", 1) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1] or "") for r in awkward_rows()]


@pytest.fixture(scope="module")
def table_rows():
    return duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


# ---- packing and id files


def check_packing(found, rows):
    model = Tokenizer.from_file(WORD)
    expected = {}
    for doc_id, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        expected.setdefault(doc_id, []).append(np.array(ids, "<u4"))
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == expected.keys()
    for doc_id, documents in expected.items():
        assert sum(r.length for r in pieces[doc_id]) == sum(map(len, documents))
        if len(documents) == 1:
            at = 0
            for r in sorted(pieces[doc_id], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(documents[0])
                assert r.ids_crc32 == zlib.crc32(documents[0][at : at + r.length].tobytes())
                at += r.length
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in found) / (2048 * len(sequences))


def test_packing(docs, nothing, pairs, table_rows, spark):
    check_packing(packing.pack_documents(docs, WORD, group=4).collect(), pairs)
    assert packing.pack_documents(nothing, WORD).count() == 0
    assert check_packing(queries.op3_packing(spark, SF_DIR).coalesce(1).collect(), table_rows) > 0.9


def check_ids(found, rows):
    model = Tokenizer.from_file(BYTE)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = {}, 0
    for doc_id, text in ordered:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.setdefault(doc_id, []).append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert len(found) == len(rows)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in [e[1:] for e in expected[r.doc_id]]
        if len(expected[r.doc_id]) == 1:
            assert r.start == expected[r.doc_id][0][0]


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_bit_planes(docs, nothing, pairs, spark, planes):
    folder = new_folder(spark, "ids")
    check_ids(bitplanes.read_ids(spark, folder, bitplanes.write_ids(docs, BYTE, folder, planes, block=100)).collect(), pairs)
    assert bitplanes.write_ids(nothing, BYTE, new_folder(spark, "ids")) == []
    assert bitplanes.read_ids(spark, folder, []).count() == 0


def test_bit_planes_query(spark, table_rows):
    check_ids(queries.op7_bit_planes(spark, SF_DIR).collect(), table_rows)


# ---- archives


def test_archives(spark):
    pages = spark.createDataFrame(
        [(3, "u3", "same"), (1, "u1", "same"), (2, None, None), (5, "u5", ""), (None, "u", "same"), (9, "u9", "né"), (None, "u", "alone"), (1, "u1", "same")],
        "page_id long, url string, html string",
    ).selectExpr("*", "1 as payload", "'x' as record_type", "2 as refers_to")
    folder = new_folder(spark, "warc")
    warc.write_warc(pages, folder, roll_bytes=200)
    rows = {(r.page_id, r.payload_bytes): r for r in warc.read_warc(spark, folder, "bytes").collect()}
    kinds = {k: (r.record_type, r.refers_to) for k, r in rows.items()}
    assert kinds == {
        (1, 4): ("response", None), (3, 4): ("revisit", 1), (None, 4): ("revisit", 1), (2, 0): ("response", None),
        (5, 0): ("revisit", 2), (9, 3): ("response", None), (None, 5): ("response", None),
    }
    assert bytes(rows[(9, 3)].payload) == "né".encode() and rows[(3, 4)].payload is None
    revisits = warc.read_warc(spark, folder).filter("record_type = 'revisit' and payload_bytes > 0")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan  # the source has taken both
    assert sorted(r.page_id or 0 for r in revisits.collect()) == [0, 3]
    assert warc.read_warc(spark, folder).filter("page_id in (2, 9)").count() == 2
    few = new_folder(spark, "warc")
    warc.write_warc(pages.limit(0), few)
    assert warc.read_warc(spark, few).count() == 0
    larger = new_folder(spark, "warc")
    warc.write_warc(pages, larger, min_bytes=1, gzip="false")
    assert warc.read_warc(spark, larger).filter("page_id in (2, 5) and record_type = 'response'").count() == 2


# ---- joins and dedup


def brute_components(rows, percent=80):
    sets = [set(shingles((t or "").encode()).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min([d for d in ids if d is not None], default=None) for g, ids in groups.items()}
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited_texts(n, seed):
    """Groups of copies with edits of any number, texts that share a passage, and one dense group."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    out = []
    for _ in range(n):
        base = sentence(rng, rng.randint(3, 120)).split()
        for _ in range(rng.randint(1, 4)):
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
            out.append(" ".join(words))
        out.append(sentence(rng, rng.randint(5, 40)) + " " + passage)
    base = sentence(rng, 100).split()
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        out.append(" ".join(words))
    return list(enumerate(out))


def triples(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_jaccard_components(docs, nothing, pairs):
    assert triples(ngram_join.jaccard_components(docs)) == brute_components(pairs)
    assert ngram_join.jaccard_components(nothing).count() == 0
    assert ngram_join.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("counters, block, broadcast", [(1, 2, 1_000_000), (1 << 18, 8, 0), (64, 8, 1_000_000)])
def test_jaccard_blocks_and_paths(spark, counters, block, broadcast):
    rows = edited_texts(40, block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngram_join.jaccard_components(df, counters=counters, first_block=block, broadcast=broadcast)
    assert triples(found) == brute_components(rows)


def test_jaccard_group_of_which_half_lies_below_the_bound(spark, monkeypatch):
    """Copies that differ too much from their group to be linked with it are hardly compared with it either."""
    rng = random.Random(12)
    base, rows = sentence(rng, 150).split(), []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(150), 2 if i % 2 else 40):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    made = []
    candidates = ngram_join._candidates

    def counted(*args):
        found = candidates(*args)
        made.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngram_join.jaccard_components(df)
    assert triples(found) == brute_components(rows)
    assert sum(made) <= 20 * len(rows)  # all pairs would be 44,850, those of the half that is linked 11,175


def test_one_of_each(docs, pairs):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    components = brute_components(pairs)
    assert len([r for r in rows if r[1] and r[1].strip()]) == 10
    assert [r for r in rows if r[0] in (3, 5, 9, 23)] == [(3, pairs[1][1])]
    assert {r[0] for r in rows} >= {4, 7, 8} and len([r for r in rows if r[0] == 21]) == 1 and len(components) == len(pairs)


def brute_repeats(rows, length=100):
    first = {}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in ordered:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            first.setdefault(data[i : i + length], doc_id)
    out = []
    for doc_id, text in ordered:
        data, seen, gone = (text or "").encode(), set(), set()
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if first[w] != doc_id or w in seen:
                gone.update(range(i, i + length))
            seen.add(w)
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc_id, len(data), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeats(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("large", [suffix_dedup.LARGE, 1])
def test_repeats(docs, nothing, pairs, large):
    assert repeats(suffix_dedup.remove_repeats(docs, large=large)) == brute_repeats(pairs)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("large, group", [(suffix_dedup.LARGE, 1 << 19), (2, 1 << 19)])
def test_repeats_around_passages(spark, large, group):
    rng = random.Random(12)
    passages = [sentence(rng, n) for n in (25, 40, 200)]
    rows = [(i, " ".join(sentence(rng, rng.randint(0, 30)) + rng.choice(passages)[rng.randint(0, 60) :] for _ in range(3))) for i in range(60)]
    rows += [(100 + i, t) for i, t in edited_texts(10, 5)] + [(900, "ab" * 400), (901, "b" + "ab" * 300 + "c" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert repeats(suffix_dedup.remove_repeats(df, large=large)) == brute_repeats(rows)


def test_repeats_query(spark, table_rows):
    found = sorted((tuple(r) for r in queries.op9_suffix_dedup(spark, SF_DIR).collect()), key=str)
    assert found == brute_repeats(table_rows)


@pytest.mark.parametrize("large", [suffix_dedup.LARGE, 1])
def test_repeats_in_equal_rows(spark, monkeypatch, large):
    rng = random.Random(14)
    text = sentence(rng, 60)
    words = text.split()
    edited = " ".join(words[:25] + ["otherwise"] + words[26:])
    rows = [(1, text)] * 20 + [(1, edited), (2, edited), (2, text + " " + edited), (None, edited), (None, edited), (None, None)]
    opened = []

    def counted(joined, *args):
        opened.append(found(joined, *args).count())
        return found(joined, *args)

    found = suffix_dedup._open_runs
    monkeypatch.setattr(suffix_dedup, "_open_runs", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert repeats(suffix_dedup.remove_repeats(df, large=large)) == brute_repeats(rows)
    assert sum(opened) <= 20  # equal rows bring their open runs once, not each (65)


def test_repeats_in_texts_longer_than_a_group(monkeypatch):
    rng = random.Random(13)
    text = (sentence(rng, 400) * 3).encode()
    expected = brute_repeats([(1, text.decode())])[0]
    monkeypatch.setattr(suffix_dedup, "_GROUP", 700)
    # A run cut at a group's edge has another identifier, so its bucket holds two kinds and is refined.
    runs = [r for g in suffix_dedup.groups([text], 100) for r in suffix_dedup.Scan([p for _, _, p in g], 100, 25).run.view(np.int64).tolist()]
    gone = suffix_dedup.repeated([text], [None], [runs], [None], 100, 25)[0]
    assert int(gone.sum()) == expected[2]


# ---- fingerprints


def test_fingerprints(docs, nothing, pairs, spark, table_rows):
    def check(found, rows):
        by_id = {}
        for d, t in rows:
            by_id.setdefault(d, []).append(t or "")
        single = sorted(d for d, t in by_id.items() if d is not None and len(t) == 1)
        got = {}
        for r in found:
            got.setdefault(r.doc_id, []).append(r)
        assert {d: len(t) for d, t in by_id.items()} == {d: len(r) for d, r in got.items()}
        same = {}
        for r in found:
            assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        order = sorted(by_id, key=lambda d: (d is not None, d or 0))
        for a, b in zip(order, order[1:] + order[:1]):
            if len(by_id[a]) == 1 == len(by_id[b]):
                text, following = by_id[a][0], by_id[b][0]
                quarter = len(text) // 4
                changed = text[: len(text) - quarter] + following[:quarter]
                r = got[a][0]
                assert r.n_chars == len(text)
                assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
                x, y = shingles(text.encode()), shingles(changed.encode())
                if len(x) > 200:
                    assert abs(r.near_edited - len(np.intersect1d(x, y)) / len(np.union1d(x, y))) < 0.2
                assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert single

    check(fingerprints.fingerprint_documents(docs).collect(), pairs)
    check(queries.op6_minhash_fingerprints(spark, SF_DIR).collect(), table_rows)
    assert fingerprints.fingerprint_documents(nothing).count() == 0
    one = fingerprints.fingerprint_documents(docs.filter("doc_id = 5")).first()
    assert one.near_next == 1.0


# ---- rules, classifiers


def test_quality_rules(docs, nothing, pairs):
    judged = fertility.quality_rules(docs, PIECE)
    rows = judged.collect()
    assert len(rows) == len(pairs) and rows[0]["row"].asDict().keys() == set(docs.columns)
    for r in rows:
        text = r["row"].text or ""
        words = text.encode().split()
        assert r.n_words == len(words) and r.word_chars == sum(len(w.decode()) for w in words)
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
        assert not (r.base_failed and r.kept)
    assert fertility.quality_rules(nothing, PIECE).count() == 0
    assert fertility.quality_rules(docs.drop("lang"), PIECE).count() == len(pairs)


def test_rules_and_classifier_keep_good_text(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = queries.op2_tokeniser_fertility(spark, SF_DIR).join(labels, "doc_id")
    assert judged.filter("quality = 1 and not base_failed and not kept").count() == 0
    drawn = queries.op10_importance_resampling(spark, SF_DIR)
    assert drawn.count() == documents.count()
    good = drawn.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    shares = {r.quality: r.share for r in good.collect()}
    assert shares[1] > 0.95 and shares[0] < shares[1]


PROSE = {
    "en": """Call me Ishmael. Some years ago, never mind how long precisely, having little or no money in my purse, and nothing
    particular to interest me on shore, I thought I would sail about a little and see the watery part of the world. It is a way I
    have of driving off the spleen and regulating the circulation. Whenever I find myself growing grim about the mouth, whenever
    it is a damp, drizzly November in my soul, whenever I find myself involuntarily pausing before coffin warehouses, and bringing
    up the rear of every funeral I meet, then I account it high time to get to sea as soon as I can.""",
    "de": """Als Gregor Samsa eines Morgens aus unruhigen Träumen erwachte, fand er sich in seinem Bett zu einem ungeheueren
    Ungeziefer verwandelt. Er lag auf seinem panzerartig harten Rücken und sah, wenn er den Kopf ein wenig hob, seinen gewölbten,
    braunen, von bogenförmigen Versteifungen geteilten Bauch, auf dessen Höhe sich die Bettdecke, zum gänzlichen Niedergleiten
    bereit, kaum noch erhalten konnte. Seine vielen, im Vergleich zu seinem sonstigen Umfang kläglich dünnen Beine flimmerten ihm
    hilflos vor den Augen.""",
    "es": """En un lugar de la Mancha, de cuyo nombre no quiero acordarme, no ha mucho tiempo que vivía un hidalgo de los de lanza
    en astillero, adarga antigua, rocín flaco y galgo corredor. Una olla de algo más vaca que carnero, salpicón las más noches,
    duelos y quebrantos los sábados, lentejas los viernes, algún palomino de añadidura los domingos, consumían las tres partes de
    su hacienda.""",
    "fr": """Longtemps, je me suis couché de bonne heure. Parfois, à peine ma bougie éteinte, mes yeux se fermaient si vite que je
    n'avais pas le temps de me dire que je m'endormais. Et, une demi-heure après, la pensée qu'il était temps de chercher le
    sommeil m'éveillait; je voulais poser le volume que je croyais avoir encore dans les mains et souffler ma lumière.""",
    None: """The quality of the documentation is particularly important for organisations which maintain international
    infrastructure. Administrators generally understand individual requirements, nevertheless misunderstandings between
    departments happen regularly. Communication, responsibility and continuous improvement therefore remain essential
    characteristics of successful development, especially wherever experienced professionals collaborate across different
    countries, languages and organisational cultures without personally meeting each other during the project.""",
}


def test_rules_keep_public_prose_and_reject_junk(spark):
    df = spark.createDataFrame([(i, " ".join(t.split()), lang) for i, (lang, t) in enumerate(PROSE.items())], "doc_id long, text string, lang string")
    found = fertility.quality_rules(df, PIECE).collect()
    assert len(found) == 5 and all(r.n_tokens >= fertility.MIN_TOKENS and r.kept for r in found)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = queries.op2_tokeniser_fertility(spark, SF_DIR).join(labels, "doc_id").filter("not base_failed and n_tokens >= 64")
    bad, good = (judged.filter(F.col("quality") == q).agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (0, 1))
    assert good == 1.0 and bad < 0.6


def test_resampling(docs, nothing, spark):
    labels = spark.createDataFrame([(5, 1, 0), (20, 1, 0), (13, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for k in (0, 1, 5, 100):
        drawn = importance.resample(docs, labels, k=k).collect()
        kept = [r for r in drawn if r.kept]
        assert len(drawn) == docs.count()
        assert min([r.key for r in kept], default=1e9) >= max([r.key for r in drawn if not r.kept], default=-1e9)
        ties = len(kept) - len({r.key for r in kept})
        assert min(k, len(drawn)) <= len(kept) <= min(k, len(drawn)) + ties + 2 if k else not kept
    assert importance.resample(nothing, labels).count() == 0
    assert importance.resample(docs, labels.limit(0)).filter("not kept").count() == 0


def test_resampling_with_wrong_labels(spark):
    rng = random.Random(12)
    kinds = [[f"{k}{i}" for i in range(300)] for k in "bg"]
    rows = [(i, " ".join(rng.choices(kinds[i % 4 > 0], k=80))) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Of 300 bad rows 10 are labelled good, of 900 good ones 20 bad.
    marks = [(i, int((i % 4 > 0) != (i % 120 == 0 or i % 45 == 1))) for i, _ in rows]
    drawn = importance.resample(df, spark.createDataFrame(marks, "doc_id long, quality int"))
    kept = {r["row"].doc_id for r in drawn.filter("kept").collect()}
    assert sum(i % 4 == 0 for i in kept) < 15 and sum(i % 4 > 0 for i in kept) >= 850
    good, bad = np.r_[np.linspace(0, 1, 200), -5.0, -4.0], np.r_[np.linspace(-6, -1, 50), 0.5]
    assert -1 < importance.edge_of(good, bad) <= 0
    assert importance.edge_of(good, bad[:0]) == pytest.approx(np.quantile(good, 0.01)) and importance.edge_of(good[:0], bad) is None
    assert np.mean(good >= importance.edge_of(good, good)) >= 0.94  # kinds that are alike


def plain_buckets(text):
    """Buckets of words and pairs by whole numbers, a word at a time."""
    mask = (1 << 64) - 1

    def finish(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return (x ^ (x >> 31)) % importance.BUCKETS

    words = re.findall(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+", (text or "").encode().lower())
    hashes = [xxhash.xxh3_64_intdigest(w) for w in words]
    pairs = [finish((a * 0x9E3779B97F4A7C15 + b) & mask) for a, b in zip(hashes, hashes[1:])]
    return [finish((h + 1) & mask) for h in hashes] + pairs


def test_resampling_by_hand(spark, table_rows):
    """Models, scores, edge and draw of the query, recomputed in plain Python."""
    drawn = {r.doc_id: r for r in queries.op10_importance_resampling(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality is not null").select("doc_id", "quality")
    held = {r[0]: r[1] for r in labels.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0).collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    raw, target = Counter(), Counter()
    for doc_id, text in table_rows:
        raw.update(plain_buckets(text))
        if quality.get(doc_id) == 1 and not held[doc_id]:
            target.update(plain_buckets(text))
    n, total, good = importance.BUCKETS, sum(raw.values()), sum(target.values())
    weight = n * good / total
    score = {}
    for doc_id, text in table_rows:
        logs = []
        for b in plain_buckets(text):
            p = (raw[b] + 1) / (total + n)
            logs.append(math.log((target[b] + weight * p) / (good + weight) / p))
        score[doc_id] = sum(logs) / len(logs) if logs else 0.0
    assert drawn.keys() == score.keys()
    assert all(drawn[d].log_importance == pytest.approx(s, abs=1e-9) for d, s in score.items())
    kinds = [[score[d] for d in quality if d in score and held[d] and quality[d] == q] for q in (1, 0)]
    ordered = sorted(kinds[0] + kinds[1])
    places = [ordered[0]] + [(a + b) / 2 for a, b in zip(ordered, ordered[1:]) if a < b]
    gaps = [round(sum(x >= p for x in kinds[0]) / len(kinds[0]) - sum(x >= p for x in kinds[1]) / len(kinds[1]), 9) for p in places]
    edge = min(places[gaps.index(max(gaps))], float(np.quantile(kinds[0], 0.05)))
    k = sum(s >= edge for s in score.values())
    noise = spark.createDataFrame(table_rows, "doc_id long, text string").select(
        "doc_id", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), F.lit(11))
    )
    key = {}
    for doc_id, value in noise.collect():
        unit = (((value & ((1 << 64) - 1)) >> 12) + 0.5) / (1 << 52)
        key[doc_id] = score[doc_id] / 0.002 - math.log(-math.log(unit))
    least = sorted(key.values(), reverse=True)[k - 1]
    assert {d for d, r in drawn.items() if r.kept} == {d for d, x in key.items() if x >= least - 1e-6}


def test_samples_are_bounded_under_repeated_ids(spark):
    rows = [(i % 3, f"text {i} of the row", "en") for i in range(300)] + [(1, None, "en"), (9, "alone", "en"), (None, "none", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    marks = [(0, 0, 0), (1, 1, 1), (2, 0, 0), (2, 0, 0), (9, 1, 1), (50, 0, 0), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = importance._sample(df, labels, 100).collect()
    assert sorted((bytes(r.data), r.quality) for r in found) == [
        (b"", 1), (b"alone", 1), (b"text 0 of the row", 0), (b"text 101 of the row", 0)
    ]
    assert importance._sample(df, labels, 2).count() <= 2
    model = compression_toxicity.fit(df, labels)
    scored = compression_toxicity.score(df, model)
    assert scored.count() == len(rows) and scored.filter("score < 0 or score > 1").count() == 0
    assert importance.resample(df, labels).count() == len(rows)


def test_threshold_by_histogram(spark):
    rng = np.random.default_rng(3)
    values = [float(x) for x in np.r_[rng.normal(size=3000), [7.5] * 50, rng.normal(size=10) * 1e9]]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    ordered = sorted(values, reverse=True)
    for k in (1, 5, 20, 60, 1000, 3060, 5000):
        assert importance.threshold_of_top(df, "x", k) == ordered[min(k, len(values)) - 1]
    assert importance.threshold_of_top(df.limit(0), "x", 3) is None and importance.threshold_of_top(df, "x", 0) is None


def test_toxicity(spark, docs, nothing):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        words, toxic = sentence(rng, 60).split(), i % 4 == 0
        if toxic:
            for _ in range(5):
                words.insert(rng.randrange(60), rng.choice(["Blockhead,", "nitwit", "dunce.", "simpleton"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = compression_toxicity.fit(df, labels)
    found = compression_toxicity.score(df, model).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95
    flipped = labels.withColumn("toxic", F.when(compression_toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert compression_toxicity.fit(df, flipped) == model  # labels of held-out rows are not read
    odd = compression_toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in odd)
    assert compression_toxicity.score(nothing, compression_toxicity.fit(nothing, labels)).count() == 0
    assert compression_toxicity.score(docs, compression_toxicity.fit(docs, labels.limit(0))).count() == docs.count()


def test_toxicity_of_many_rare_insults(spark):
    rng = random.Random(13)
    insults = ["".join(rng.choices("bcdfgjklmpquvwxyz", k=7)) for _ in range(120)]
    rows = []
    for i in range(1600):
        words = sentence(rng, 60).split()
        if i % 4 == 0:
            for insult in rng.sample(insults, 2):  # each in some 4 of 267 toxic texts learnt from
                words.insert(rng.randrange(60), insult)
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    held = compression_toxicity.score(df, compression_toxicity.fit(df, labels)).filter("held_out").collect()
    flagged = [r.predicted == 1 for r in held if r.doc_id % 4 == 0]
    assert np.mean(flagged) > 0.5 and np.mean([r.predicted for r in held if r.doc_id % 4]) < 0.05


# ---- SentencePiece


@pytest.mark.parametrize("chunk", [17, 500, 16_384])
def test_sentence_scan(docs, nothing, pairs, monkeypatch, chunk):
    monkeypatch.setattr(sentence_scan, "FAN", 4 if chunk > 17 else 64)
    v = sentence_scan.vocabulary(PIECE)
    parts = sentence_scan.encode_parts(docs, PIECE, chunk)
    decoded = [sentence_scan.decode(part, PIECE) for part in parts if part is not None]
    assert len(decoded) == 2
    documents = {}
    for part in decoded:
        for k, r in enumerate(part.orderBy("chunk").collect()):
            ids, text = documents.setdefault((r.doc_id, k if r.key is None else f"long {r.key}"), ([], []))
            ids += r.ids
            text.append(r.text)
    got = sorted((str(k[0]), "".join(t), i) for k, (i, t) in documents.items())
    assert got == sorted((str(d), t, v.encode(v.normalize(t))[1]) for d, t in pairs)
    assert sentence_scan.encode(nothing, PIECE).count() == 0
    sums = sentence_scan.digests(*decoded).collect()

    def weighted(values):
        return str(sum((i + 1) * x for i, x in enumerate(values)))

    expected = sorted((d or -1, len(t), weighted(map(ord, t)), len(i), weighted(i)) for (d, t) in pairs for i in [v.encode(v.normalize(t))[1]])
    assert sorted((r.doc_id or -1, r.n_chars, r.chars_sum, r.n_tokens, r.ids_sum) for r in sums) == expected


# ---- queries and pipeline

SQL = {name: sql for name, (_, sql) in queries.REGISTRY.items() if sql}


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = queries.REGISTRY[name][0](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert ours == sorted(tuple(str(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_pipeline_stages(spark, docs, nothing):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns
        assert stage(spark, nothing, SF_DIR).count() == 0
    assert corpus_pipeline.pack(spark, kept, SF_DIR).count() > 0


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    good = {r.doc_id for r in rows}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 0")
    bad = {r.doc_id for r in labels.collect()}
    assert 100 < len(good) < 200 and len(good & bad) <= len(bad) // 2
