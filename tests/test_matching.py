"""Factored matches and joins that treat frequent keys apart."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from aulario.operators import heavy
from aulario.operators.factored import factor
from aulario.operators.heavy import heavy_keys, split_join


def side(spark, rng, n, names, keys=6):
    rows = [(rng.choice([None, None, *range(keys)]), rng.choice(["x", None]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"id int, area string, {names} int")


def joined(a, b, how):
    out = []
    for r in a:
        found = [s for s in b if s[:2] == r[:2]]
        out += [(*r, s[2]) for s in found] or ([(*r, None)] if how == "left" else [])
    return out


@pytest.mark.parametrize("hows", [("inner", "inner"), ("left", "inner"), ("inner", "left"), ("left", "left")])
def test_factored_match_equals_the_join(spark, hows):
    rng = random.Random(3)
    (ra, a), (rb, b), (rc, c) = side(spark, rng, 25, "a"), side(spark, rng, 12, "b", 9), side(spark, rng, 7, "c", 4)
    expected = [(*r, s) for r in joined(ra, rb, hows[0]) for s in [x[-1] for x in joined([r[:3]], rc, hows[1])]]
    match = factor(a, [(b, hows[0]), (c, hows[1])], ["id", "area"])
    assert Counter(map(tuple, match.unrolled().select("id", "area", "a", "b", "c").collect())) == Counter(expected)
    assert match.n_rows().first().links == len(expected)
    assert {(r.id, r.area): int(r.links) for r in match.links().collect()} == Counter(r[:2] for r in expected)
    for i, name in enumerate("abc"):
        weights = {r[name]: int(r.links) for r in match.weighted(i).select(name, "links").collect()}
        assert weights == Counter(r[2 + i] for r in expected if r[2 + i] is not None)


def test_factored_match_stays_small_where_the_join_explodes(spark):
    n = 20_000
    half = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("key"), F.col("id").alias("a"))
    match = factor(half, [(half.withColumnRenamed("a", "b"), "inner"), (half.withColumnRenamed("a", "c"), "left")], ["key"])
    assert match.groups.count() == n // 2 + 1
    assert match.weighted().count() == n
    assert match.n_rows().first().links == n // 2 + (n // 2) ** 3


def test_factored_match_of_nothing_and_of_wrong_sides(spark):
    some, none = spark.createDataFrame([(1, 2)], "k int, a int"), spark.createDataFrame([], "k int, b int")
    assert factor(some, [(none, "inner")], ["k"]).n_rows().first().links == 0
    assert factor(some, [(none, "left")], ["k"]).n_rows().first().links == 1
    assert factor(none, [(some, "left")], ["k"]).weighted().count() == 0
    with pytest.raises(ValueError, match="more than one side: a"):
        factor(some, [(some, "inner")], ["k"])
    with pytest.raises(ValueError, match="how must be"):
        factor(some, [(none, "full")], ["k"])


def skewed(spark, n=90_000):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    return spark.range(n).select(key.cast("long").alias("k"), F.lit("s").alias("k2"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_the_join(spark, how):
    big = skewed(spark)
    small = spark.range(0, 6000, 2).select(F.col("id").alias("k"), F.lit("s").alias("k2"), (F.col("id") * 2).alias("w"))
    small = small.unionByName(spark.createDataFrame([(7, "s", 99), (None, "s", 1)], "k long, k2 string, w long"))
    got = split_join(big, small, ["k", "k2"], how)
    expected = big.join(small, ["k", "k2"], how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert split_join(big.limit(0), small, ["k", "k2"], how).count() == 0
    assert split_join(big.limit(50), small.limit(0), ["k", "k2"], how).count() == (50 if how == "left" else 0)


def test_frequent_keys_are_found_and_few(spark):
    big = skewed(spark)
    hot = heavy_keys(big, ["k"])
    assert hot == [big.filter("k = 7").select(F.xxhash64("k")).first()[0]]
    assert heavy_keys(spark.range(10_000).withColumnRenamed("id", "k"), ["k"]) == []
    assert heavy_keys(big.filter("k IS NULL"), ["k"]) == []
    assert len(heavy_keys(spark.range(100).select((F.col("id") % 4).alias("k")), ["k"], parts=8)) == 4


def test_largest_task_stays_below_twice_the_median(spark, monkeypatch):
    big = skewed(spark)
    hot = heavy_keys(big, ["k"])
    h = heavy.key_hash(["k"])
    shuffled = big.filter(h.isNotNull() & ~h.isin(hot)).repartition(8, "k")
    tasks = [r["count"] for r in shuffled.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 8 and max(tasks) < 2 * median(tasks)
    plain = [r["count"] for r in big.dropna(subset=["k"]).repartition(8, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > 2 * median(plain)
