"""Every registered query against its SQL, on the smallest test set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from aulario.queries import all_queries

SF_DIR = os.environ.get("AULARIO_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLE = entry_module.oracle_sql()
QUERIES = {name: entry_module.queries()[name] for name in all_queries()}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert forbidden not in plan
    columns = sorted(df.columns)
    ours = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
