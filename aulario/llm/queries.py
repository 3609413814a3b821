"""Registered queries of the training-data operators, with the SQL that must agree with them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aulario.llm import bitplanes, byte_network, compression_toxicity, fertility, fingerprints, importance, ngram_join, packing, sentence_scan, spelling_groups, suffix_dedup, target_resampling, warc
from aulario.llm.common import new_folder, table
from aulario.queries.register import Registry

REGISTRY = Registry()
CAPACITY = 2048

_SHA = "sha1(coalesce(html, ''))"


@REGISTRY.query(f"""
with p as (
  select page_id, coalesce(html, '') as payload, {_SHA} as h,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr({_SHA}, ((i // 4) * 5 + 1)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)),
      'string_agg', '') as digest
  from pages
), f as (select h, payload, min(page_id) as first_id from p group by h, payload)
select p.page_id, strlen(p.payload)::bigint as payload_bytes, p.digest as payload_digest,
  case when p.page_id = f.first_id then 'response' else 'revisit' end as record_type,
  case when p.page_id = f.first_id then null else f.first_id end as refers_to
from p join f on p.h = f.h and p.payload = f.payload
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back and verify the payloads."""
    folder = new_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_warc(spark, folder, payload="verify").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@REGISTRY.query(None)
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 ids."""
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), CAPACITY
    )


@REGISTRY.query(None)
def op7_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as compressed bit planes and read them back."""
    folder = new_folder(spark, "idplanes")
    files = bitplanes.write_ids(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder
    )
    return bitplanes.read_ids(spark, folder, files)


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x20\\x09-\\x0D]+')"
)


@REGISTRY.query(f"""
with recursive w as (select doc_id, {_WORDS} as ws from documents),
s as (
  select distinct doc_id, unnest(case
    when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g
  from w
),
n as (select w.doc_id, count(s.g) as n from w left join s on s.doc_id = w.doc_id group by w.doc_id),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (
  select o.a, o.b from o join n x on x.doc_id = o.a join n y on y.doc_id = o.b
  where 100 * o.o >= 80 * (x.n + y.n - o.o)
),
r as (select doc_id, doc_id as x from n union select r.doc_id, l.b from r join l on l.a = r.x)
select n.doc_id, n.n::bigint as n_shingles, min(r.x) as component_id
from n join r on r.doc_id = n.doc_id group by n.doc_id, n.n
""")
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their five-word shingles."""
    found = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), percent=80, words=5)
    return found.select("doc_id", "n_shingles", "component_id")


@REGISTRY.query(None)
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every byte covered by a 100-byte string that starts earlier."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@REGISTRY.query(None)
def op2_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain quality rules and fertility bands over all documents."""
    judged = fertility.quality_rules(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return judged.select("row.doc_id", *[c for c in judged.columns if c != "row"])


@REGISTRY.query(None)
def op6_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@REGISTRY.query(None)
def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance of all documents and the draw."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.select("row.doc_id", "n_grams", "log_importance", "kept")


@REGISTRY.query(None)
def op5_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = compression_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return compression_toxicity.score(docs, model)


@REGISTRY.query(None)
def op4_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents; sums over ids and over the characters decoded from them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    parts = sentence_scan.encode_parts(table(spark, sf_dir, "documents"), path)
    return sentence_scan.digests(*(part if part is None else sentence_scan.decode(part, path) for part in parts))


@REGISTRY.query(None)
def op11_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return byte_network.predict(docs, byte_network.fit(docs))


# CRC-32 of a text, bit by bit from its polynomial: eight halvings per byte of its UTF-8 form.
def _crc32(text: str) -> str:
    byte = f"('0x' || substr(hex({text}), (2 * i + 1)::bigint, 2))::bigint"
    steps = f"flatten(list_transform(range(strlen({text})), lambda i: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {steps}), lambda c, x: {fold}))"


_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_GAIN = "floor(1000 * ln(((t + 1)::double * (sum(s) over () + 10000)::double) / ((s + 1)::double * (sum(t) over () + 10000)::double)))"
_H = "('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint::double"


@REGISTRY.query(f"""
with f as (
  select 0 as kind, doc_id, unnest(regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from documents
  union all
  select 1, item_id, unnest(regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) from benchmark
),
v as materialized (select w, {_crc32('w')} % 10000 as bucket from (select distinct w from f)),
b as (
  select range as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from range(10000) left join
    (select bucket, count_if(kind = 0) as s, count_if(kind = 1) as t from f join v using (w) group by bucket) c on c.bucket = range
),
g as (select bucket, ({_GAIN})::bigint as gain from b),
d as (
  select doc_id, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
  from f join v using (w) join g using (bucket) where kind = 0 group by doc_id
),
x as (
  select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln(({_H} + 0.5::double) / 4294967296::double)))::bigint as score
  from documents left join d using (doc_id)
),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from x where n_features >= 20)
select x.*, case when r.rank <= r.n * 10 // 100 then r.rank end as rank from x left join r using (doc_id)
""")
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark's word distribution, and the draw of a tenth of them."""
    return target_resampling.resample_to_target(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20, longest=1, buckets=10_000, seed=2024
    )


_REST = "unnest(list_distinct(list_transform(range(length(word)), lambda i: word[:i::bigint] || {mark} || word[i + 2:])))"


@REGISTRY.query(f"""
with recursive f as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as text from documents),
c as (select doc_id, {_FOLDED} as run, count(*) as n from f group by all),
h as (select *, {_crc32("(doc_id::varchar || ':' || run)")} as h from c),
o as (
  select case when h % 199 = 0 then run[:(h % length(run))::bigint] || run[(h % length(run) + 2)::bigint:] else run end as word, n
  from h
),
w as materialized (select word, sum(n)::bigint as n from o where length(word) >= 6 group by word having sum(n) >= 5),
blank as (select word, {_REST.format(mark="'*'")} as rest from w),
short as (select word, {_REST.format(mark="''")} as rest from w),
near as materialized (
  select distinct x.word, y.word as near from blank x join blank y on x.rest = y.rest and x.word <> y.word
  union select x.word, x.rest from short x join w on w.word = x.rest
  union select x.rest, x.word from short x join w on w.word = x.rest
),
told as (
  select near.word, count(*) as n_near, max(y.n) as top
  from near join w y on y.word = near.near group by near.word
),
first as (select near.word, min(near.near) as form from near join w y on y.word = near.near join told on told.word = near.word and y.n = told.top group by near.word),
r as materialized (
  select w.word, w.n, coalesce(told.n_near, 0)::bigint as n_near,
    case when told.top >= 5 * w.n then first.form end as form, case when told.top >= 5 * w.n then told.top end::bigint as form_n
  from w left join told using (word) left join first using (word)
),
walk as (
  select word, word as at from r
  union select walk.word, r.form from walk join r on r.word = walk.at where r.form is not null
)
select r.*, walk.at as root from r join walk on walk.word = r.word join r e on e.word = walk.at and e.form is null
""")
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling_groups.spelling_groups(table(spark, sf_dir, "documents"), every=199, min_length=6, min_count=5, ratio=5)


def queries() -> dict:
    return dict(REGISTRY)
