"""Stored profiles: merged equal direct, exact fields exactly and sketches within their error."""

import random

import pytest
from pyspark.sql import functions as F

from aulario.operators import profiles
from tests.conftest import rows

SCHEMA = "id long, v double, t string, n int"


def some(spark, seed, n=3000):
    rng = random.Random(seed)
    data = [(rng.randint(0, 20_000), rng.choice([None, rng.gauss(0, 10)]), rng.choice([None, "a", "b", f"x{rng.randint(0, 400)}"]), None) for _ in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def test_merged_equals_direct(spark, tmp_path):
    parts = [some(spark, i) for i in range(3)]
    path = str(tmp_path / "profiles")
    for i, part in enumerate(parts):  # a new file adds its rows to what is stored
        profiles.file_profile(part, f"f{i}").write.mode("append").parquet(path)
    found = {r.variable: r for r in profiles.merged_codebook(spark.read.parquet(path), digits=3).collect()}
    whole = parts[0].union(parts[1]).union(parts[2])
    assert set(found) == set(whole.columns)
    for c, kind in whole.dtypes:
        r = found[c]
        n, nulls, distinct, low, high = whole.agg(
            F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.count_distinct(c), F.min(c), F.max(c)
        ).first()
        assert (r.type, r.nulls, r.null_percent) == (kind, nulls, round(nulls * 100 / n, 3))
        assert r.distinct_values == pytest.approx(distinct, rel=0.05)
        if c in ("id", "v"):
            assert (r.minimum, r.maximum) == (low, high)
            for name, q in profiles.QUANTILES.items():
                rank = whole.filter(F.col(c) <= r[name]).count() / (n - nulls)
                assert abs(rank - q) < 0.03
        else:
            assert (r.minimum, r.maximum, r.median) == (None, None, None)


def test_files_that_differ_and_repeat(spark):
    a = spark.createDataFrame([("1", 5), (None, 6)], "k string, x int")
    b = spark.createDataFrame([(1, "y"), (2, None), (2, "z")], "k int, t string")
    parts = [profiles.file_profile(a, "a"), profiles.file_profile(b, "b"), profiles.file_profile(a, "a")]
    parts.append(profiles.file_profile(a.limit(0), "empty"))
    found = profiles.merged_codebook(parts)
    assert rows(found, "variable", "type", "nulls", "null_percent", "distinct_values", "minimum", "maximum", "median") == sorted(
        [("k", "int, string", 1, 20.0, 2, 1.0, 2.0, 2.0), ("t", "string", 3, 60.0, 2, None, None, None), ("x", "int", 3, 60.0, 2, 5.0, 6.0, 5.0)],
        key=repr,
    )


def test_profile_is_one_pass(spark):
    plan = profiles.file_profile(some(spark, 1, 50), "f")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning" not in plan and "Expand" not in plan
