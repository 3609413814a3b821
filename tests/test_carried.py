"""Storage by key and state carried between runs."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from aulario.queries.carried import day_gaps
from aulario.sources.by_key import stage_by_key
from aulario.sources.stages import stage_folder
from aulario.streaming import carried
from aulario.streaming.carried import KeyState, carry, new_files

SCHEMA = "child string, day date, status string, hours double, note string"
STATE = KeyState(
    key="child",
    least={"first_a": "CASE WHEN status = 'A' THEN day END"},
    most={"most_hours": "hours"},
    total={"hours": "hours", "n": "1"},
    latest=("day", "status", "note"),
)


def some_rows(rng, n):
    day = dt.date(2025, 3, 1)
    return [
        (
            rng.choice([None, "hot", "hot", *(f"c{i}" for i in range(12))]),
            rng.choice([None, *(day + dt.timedelta(i) for i in range(20))]),
            rng.choice(["A", "F", None]),
            rng.choice([None, 0.5, 2.0, 4.0]),
            rng.choice([None, "", "x", "ñ"]),
        )
        for _ in range(n)
    ]


def plain(rows, null_wins=True):
    """The same state by a loop over all rows."""
    out = {}
    for child in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == child]
        days = [r[1] for r in mine if r[2] == "A" and r[1]]
        hours = [r[3] for r in mine if r[3] is not None]

        def order(r):
            # A null date leads or trails; other nulls trail.
            return ((r[1] is None) == null_wins, r[1] or dt.date.min, r[2] is not None, r[2] or "", r[4] is not None, r[4] or "")

        last = max(mine, key=order)
        out[child] = (min(days, default=None), max(hours, default=None), sum(hours) if hours else None, len(mine), last[1], last[2], last[4])
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.fixture
def place(spark):
    return f"{stage_folder(spark).rstrip('/')}/carried-{uuid.uuid4().hex}"


def add(spark, place, rows, files=1):
    df = spark.createDataFrame(rows, SCHEMA).repartition(files)
    df.write.mode("append").parquet(f"{place}/files")
    return df.schema


def run(spark, place, schema, state=STATE, per_batch=None, buckets=4):
    return carry(new_files(spark, f"{place}/files", schema, per_batch), state, f"{place}/state", buckets)


@pytest.mark.parametrize("null_wins", [True, False])
def test_runs_equal_one_run_over_all(spark, place, null_wins):
    rng = random.Random(5)
    state = KeyState("child", STATE.least, STATE.most, STATE.total, STATE.latest, null_wins)
    every = []
    for n, files, per_batch in ((40, 3, 1), (1, 1, None), (60, 2, None)):
        fresh = some_rows(rng, n)
        every += fresh
        schema = add(spark, place, fresh, files)
        assert found(run(spark, place, schema, state, per_batch)) == plain(every, null_wins)


def test_a_run_without_new_files_reads_none(spark, place):
    rows = some_rows(random.Random(6), 30)
    schema = add(spark, place, rows)
    run(spark, place, schema)
    versions = carried._versions(f"{place}/state")
    assert found(run(spark, place, schema)) == plain(rows)
    assert carried._versions(f"{place}/state") == versions


def test_a_failed_run_counts_nothing_twice(spark, place, monkeypatch):
    rng = random.Random(7)
    first, second = some_rows(rng, 30), some_rows(rng, 30)
    schema = add(spark, place, first)
    run(spark, place, schema)
    add(spark, place, second)
    write = carried.write_by_key

    def broken(*args):
        write(*args)
        raise OSError("lost after the version was written")

    monkeypatch.setattr(carried, "write_by_key", broken)
    with pytest.raises(StreamingQueryException):
        run(spark, place, schema)
    monkeypatch.setattr(carried, "write_by_key", write)
    assert found(run(spark, place, schema)) == plain(first + second)


def test_number_of_buckets_may_change(spark, place):
    rng = random.Random(8)
    first, second = some_rows(rng, 30), some_rows(rng, 30)
    schema = add(spark, place, first)
    run(spark, place, schema, buckets=4)
    add(spark, place, second)
    assert found(run(spark, place, schema, buckets=7)) == plain(first + second)


def test_a_missing_version_is_an_error(spark, place):
    rng = random.Random(9)
    schema = add(spark, place, some_rows(rng, 10))
    run(spark, place, schema)
    system, root = carried.filesystem(f"{place}/state")
    system.delete_dir(f"{root}/versions")
    add(spark, place, some_rows(rng, 10))
    with pytest.raises(StreamingQueryException, match="no version 0"):
        run(spark, place, schema)


def test_no_files_give_an_empty_state(spark, place):
    schema = add(spark, place, [])
    assert run(spark, place, schema).count() == 0


def test_old_versions_go(spark, place):
    rng = random.Random(10)
    for _ in range(4):
        schema = add(spark, place, some_rows(rng, 5))
        run(spark, place, schema)
    assert sorted(carried._versions(f"{place}/state")) == [2, 3]


def test_the_stored_state_is_not_shuffled(spark, place):
    rows = some_rows(random.Random(11), 30)
    schema = add(spark, place, rows)
    run(spark, place, schema, buckets=8)
    empty = STATE.reduced(spark.createDataFrame([], schema))
    old = carried._version(spark, f"{place}/state", 0, empty.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = STATE.merged(old, STATE.reduced(spark.createDataFrame(rows, schema)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "FileScan parquet" in plan


def test_windows_by_child_need_no_exchange(spark):
    rows = [(c, d, 1) for c in ("a", "b", None) for d in (dt.date(2025, 3, 1), dt.date(2025, 3, 4), None)]
    days = stage_by_key(spark.createDataFrame(rows, "DNI__c string, FECHA__c date, n_rows long"), "DNI__c", "days", 8)
    gaps = day_gaps(days)
    assert "Exchange" not in gaps._jdf.queryExecution().executedPlan().toString()
    got = {(r.DNI__c, r.FECHA__c): (r.day_number, r.gap, r.rows_so_far) for r in gaps.collect()}
    for child in ("a", "b", None):
        assert [got[child, d] for _, d, _ in rows[:3]] == [(2, None, 2), (3, 3, 3), (1, None, 1)]
    first = days.withColumn("first", F.min("FECHA__c").over(Window.partitionBy("DNI__c")))
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
