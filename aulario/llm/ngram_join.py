"""Exact Jaccard self-join of documents on word n-grams, as a blocked sparse matrix product.

The incidence matrix has a row per distinct n-gram set and a column per n-gram; entries of A A^T
are overlap counts. Two sets of sizes a and b reach similarity t only if they share at least
t (a + b) / (1 + t) n-grams, and then they share one among the first n - ceil(t n) + 1 n-grams of
either, in any order of the n-grams that is the same for all sets. So the product is taken
over those leading columns alone, and full overlaps only for pairs that the bounds let pass.

1. A first pass counts, in a table of fixed size, how many texts hold an n-gram of each hashed bucket.
   The order of the columns puts n-grams of light buckets first, then goes by hash. A text that differs much from a large
   group of near copies so leads with what is its own, and meets none of them.
2. A second pass gives each document's set size, set identity and leading n-grams. Documents
   with equal sets are one row of the matrix from here on.
3. Entries in columns of two or more rows are kept: ``token, sig, n, pos``, with the column's number of rows.
4. The product of a column runs in blocks of growing size: rows in block order are multiplied with all
   later rows. Pairs are discarded by set sizes and by what is left after ``pos``, and pairs
   already in one component are skipped, so a dense group of m near copies costs about m products
   per block instead of m^2. Blocks go on until no column has rows of two components left.
5. Of the pairs left, overlap counts are accumulated over all leading columns. With c of them the
   full overlap is at most c plus what either row has beyond its prefix; pairs that cannot reach
   the bound so are discarded, which takes away texts that share a passage and little else.
6. Pairs that remain are checked with their full sets; links give components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import batch, drop_memos, shingles, small_batches, staged, text_bytes
from aulario.llm.components import connected_components

# Counters of the order of columns; a task gives a row for each that it uses.
COUNTERS = 1 << 18
# Ids of texts to fetch that are sent to all executors (8 bytes each); beyond it they are joined.
BROADCAST = 1_000_000
FIRST_BLOCK = 8
# Text handed to a worker at once; its n-grams take some ten times as much.
_BATCH = 4 << 20
BLOCK_GROWTH = 8

_SETS = pa.schema(
    [("doc_id", pa.int64()), ("th", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()), ("low", pa.list_(pa.int64()))]
)
_FULL = pa.schema([("sig", pa.int64()), ("tokens", pa.list_(pa.int64()))])
_COUNTED = pa.schema([("counter", pa.int64()), ("n", pa.int64())])


def prefix_length(n: int, percent: int) -> int:
    """How many leading n-grams of a set of n must hold a common one of any similar set."""
    return n - -(-percent * n // 100) + 1


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    values = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _signature(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def column_order(docs: DataFrame, words: int, counters: int = COUNTERS) -> np.ndarray:
    """How many texts hold an n-gram of each counter; texts repeated within a task count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos(keep="hashes")
        total, seen = np.zeros(counters, np.int64), set()
        for incoming in batches:
            for th, data in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                if th not in seen:
                    seen.add(th)
                    total[(shingles(data, words) % np.uint64(counters)).astype(np.int64)] += 1  # once per text
        used = np.flatnonzero(total)
        for i in range(0, len(used), 65536):
            yield batch(_COUNTED, [used[i : i + 65536], total[used[i : i + 65536]]])

    texts = docs.select(F.xxhash64(text_bytes()).alias("th"), text_bytes().alias("text"))
    found = texts.mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(counters, np.int64)  # at most ``counters`` rows reach the driver
    out[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    return out


def _document_sets(docs: DataFrame, order: np.ndarray, percent: int, words: int) -> DataFrame:
    """``doc_id, th, sig, n, low``: ``th`` is a hash of the text, ``sig`` is null for texts without words, ``low`` leads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_memos(keep="hashes")
        for incoming in batches:
            sigs, sizes, lows = [], [], []
            for data in incoming.column(2).to_pylist():
                tokens = shingles(data, words)
                n = len(tokens)
                sizes.append(n)
                sigs.append(_signature(tokens) if n else None)
                weight = order[(tokens % np.uint64(len(order))).astype(np.int64)]
                # Tokens are sorted, so a stable sort breaks ties by hash.
                lows.append(tokens[np.argsort(weight, kind="stable")[: prefix_length(n, percent)]] if n else tokens)
            yield batch(_SETS, [incoming.column(0), incoming.column(1), sigs, sizes, _lists(lows)])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("th"), text_bytes().alias("text")
    ).mapInArrow(run, "doc_id long, th long, sig long, n long, low array<long>")


def _full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, words: int, broadcast: int) -> DataFrame:
    """(sig, tokens) of the wanted sets, from one text each (or more where a ``doc_id`` is repeated)."""
    ids = staged(sets.join(wanted, "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("doc_id")), "ids")
    some = F.broadcast(ids) if ids.count() <= broadcast else ids
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    found = plain.join(some, "doc_id").select("sig", "text")
    if not ids.filter("doc_id is null").isEmpty():  # sets of which no text has an id
        nameless = plain.filter("doc_id is null").select(F.lit(None).cast("long").alias("sig"), "text")
        found = found.unionByName(nameless)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            sigs, sets = [], []
            for sig, data in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                tokens = shingles(data, words)
                if len(tokens) and sig in (None, _signature(tokens)):
                    sigs.append(_signature(tokens))
                    sets.append(tokens)
            yield batch(_FULL, [sigs, _lists(sets)])

    return found.mapInArrow(run, "sig long, tokens array<long>")


def _joined(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs with the values of both sides: ``x`` of ``a`` and ``y`` of ``b``."""
    left = values.select(F.col("sig").alias("a"), F.col("v").alias("x"))
    right = values.select(F.col("sig").alias("b"), F.col("v").alias("y"))
    return pairs.join(left, "a").join(right, "b")


def _reachable(pairs: DataFrame, leading: DataFrame, percent: int) -> DataFrame:
    """Pairs whose overlap in the leading columns leaves room for the overlap that they need."""
    shared = F.size(F.array_intersect("x.tokens", "y.tokens"))
    beyond = F.greatest(*[F.ceil(F.col(f"{s}.n") * percent / 100.0) - 1 for s in ("x", "y")])
    bound = (100 + percent) * (shared + beyond) >= percent * (F.col("x.n") + F.col("y.n"))
    return _joined(pairs, leading).filter(bound).select("a", "b")


def _links(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    found = _joined(pairs, full.withColumnRenamed("tokens", "v"))
    return found.filter(100 * shared >= percent * union).select("a", "b").distinct()


def _candidates(rows: DataFrame, low: int, high: int, percent: int) -> DataFrame:
    """Pairs of a column's rows of block [low, high) with its later rows that the bounds let pass."""
    turn: Column = F.col("turn")
    block = rows.filter((turn >= low) & (turn < high)).select(
        "token",
        F.col("sig").alias("a"),
        F.col("n").alias("na"),
        F.col("pos").alias("pa"),
        F.col("turn").alias("ta"),
        F.col("comp").alias("ca"),
    )
    after = (F.col("turn") > F.col("ta")) | ((F.col("turn") == F.col("ta")) & (F.col("sig") > F.col("a")))
    sizes = (100 * F.col("na") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("na"))
    rest = F.least(F.col("n") - F.col("pos"), F.col("na") - F.col("pa"))
    bound = (100 + percent) * rest >= percent * (F.col("n") + F.col("na"))
    pairs = rows.join(block, "token").filter(after & (F.col("comp") != F.col("ca")) & sizes & bound)
    return pairs.select(F.least("a", "sig").alias("a"), F.greatest("a", "sig").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame,
    percent: int = 80,
    words: int = 5,
    counters: int = COUNTERS,
    first_block: int = FIRST_BLOCK,
    broadcast: int = BROADCAST,
) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, th, component``.

    Documents whose sets of ``words``-word n-grams have a Jaccard similarity of at least
    ``percent`` / 100 are linked; ``component_id`` is the smallest ``doc_id`` reachable by links,
    the document included. Texts with fewer words are one n-gram; null, empty and blank texts
    have none and are linked with nothing. Rows with a null or repeated ``doc_id`` are rows
    like any other (a null counts as no id). ``th`` is a hash of the text and ``component`` names the
    component (null for texts without n-grams). Other columns are not read.
    N-grams are 64-bit hashes and sets are known by a 64-bit hash of theirs.
    """
    small_batches(docs.sparkSession, _BATCH)
    order = column_order(docs, words, counters)
    sets = staged(_document_sets(docs, order, percent, words), "sets")
    matrix = sets.filter("sig is not null").groupBy("sig").agg(F.first("n").cast("int").alias("n"), F.first("low").alias("low"))
    entries = staged(matrix, "matrix").select("sig", "n", F.posexplode("low").alias("pos", "token"))
    sizes = staged(entries.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "columns")
    unit = F.pmod(F.xxhash64(F.col("sig"), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    rows = staged(
        entries.join(sizes, "token").select("token", "sig", "n", "pos", "m", (unit * F.col("m")).alias("turn")),
        "rows",
    )
    leading = staged(
        rows.groupBy("sig", "n").agg(F.collect_list("token").alias("tokens")).select("sig", F.struct("n", "tokens").alias("v")),
        "leading",
    )
    largest = rows.agg(F.max("m")).first()[0] or 0

    components = None
    low, high = 0, first_block
    while low < largest:
        if components is None:
            alive = rows.withColumn("comp", F.col("sig"))
        else:
            alive = (
                rows.filter(F.col("m") > low)
                .join(components.withColumnRenamed("node", "sig"), "sig", "left")
                .withColumn("comp", F.coalesce("component", "sig"))
            )
            mixed = alive.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
            alive = alive.join(mixed.select("token"), "token", "left_semi")
        alive = staged(alive.select("token", "sig", "n", "pos", "turn", "comp"), "alive")
        if alive.isEmpty():
            break
        pairs = staged(_reachable(_candidates(alive, low, high, percent), leading, percent), "pairs")
        if not pairs.isEmpty():
            wanted = staged(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct(), "wanted")
            full = staged(_full_sets(docs, sets, wanted, words, broadcast), "full")
            found = staged(_links(pairs, full, percent), "found")
            components = _merged(components, found)
        low, high = high, high * BLOCK_GROWTH
    return _with_components(sets, components)


def _merged(components: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components with new links, which join whole components of before."""
    if components is None:
        return connected_components(links)
    for side in ("a", "b"):
        known = components.select(F.col("node").alias(side), "component")
        links = links.join(known, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
    joined = connected_components(links)
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    before = components.join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    # Components that were single nodes until now.
    fresh = joined.join(components.select("node"), "node", "left_anti")
    return staged(before.unionByName(fresh), "merged")


def _with_components(sets: DataFrame, components: DataFrame | None) -> DataFrame:
    firsts = sets.filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("first_id"))
    if components is None:
        classes = firsts.select("sig", F.col("sig").alias("comp"), F.col("first_id").alias("component_id"))
    else:
        named = firsts.join(components.withColumnRenamed("node", "sig"), "sig", "left")
        named = staged(named.withColumn("comp", F.coalesce("component", "sig")), "named")
        smallest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
        classes = named.join(smallest, "comp").select("sig", "comp", "component_id")
    # Rows of one hot set are spread over copies of its class.
    salts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_salt")
    salt = F.pmod(F.hash("doc_id", "th"), F.lit(16)).alias("_salt")
    rows = sets.select("doc_id", "th", "sig", F.col("n").alias("n_shingles"), salt)
    return rows.join(classes.select("sig", "comp", "component_id", salts), ["sig", "_salt"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "th",
        F.col("comp").alias("component"),
    )


def one_of_each(docs: DataFrame, percent: int = 80, words: int = 5, broadcast: int = BROADCAST) -> DataFrame:
    """The rows of ``docs`` less all but one of every component.

    The row with the smallest ``doc_id`` stays (one without an id only if none has one), of equal ids
    the one with the smallest text hash. Repeated rows are one. Texts without n-grams stay.
    """
    found = staged(jaccard_components(docs, percent, words, broadcast=broadcast), "components")
    last = F.lit(2**63 - 1)
    place = F.struct(F.coalesce("doc_id", last).alias("doc"), "th")
    linked = found.filter("component is not null").select("component", place.alias("place"))
    stay = linked.groupBy("component").agg(F.min("place").alias("stay"))
    gone = staged(linked.join(stay, "component").filter("place <> stay").select("place.doc", "place.th").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= broadcast else gone
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), last).alias("doc"),
        F.xxhash64(text_bytes()).alias("th"),
    )
    kept = keyed.join(gone, ["doc", "th"], "left_anti")
    again = found.groupBy(F.coalesce("doc_id", last), "th").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    if not again.isEmpty():
        kept = kept.dropDuplicates(["doc", "th"])
    return kept.select("row.*")
