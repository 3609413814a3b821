import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aulario.operators import combine, dedup, joins, profile, reshape, schema
from tests.conftest import rows, values

FORM = "k string, ts timestamp_ntz, i int"


def at(day):
    return None if day is None else dt.datetime(2025, 1, day)


def test_latest_per_key_null_stamp_wins_and_null_keys_collapse(spark):
    df = spark.createDataFrame(
        [("a", at(1), 1), ("a", at(2), 2), ("b", at(5), 3), ("b", None, 4), (None, at(1), 5), (None, at(2), 6), ("c", at(1), 7), ("c", at(1), 8)], FORM
    )
    assert rows(dedup.latest_per_key(df, "k", "ts", ["i"]), "k", "i") == sorted(
        [("a", 2), ("b", 4), (None, 6), ("c", 8)], key=repr
    )


def test_latest_keep_null_keys(spark):
    df = spark.createDataFrame([("a", at(1), 1), ("a", None, 2), (None, at(1), 3), (None, at(1), 4), ("b", None, 5)], FORM)
    assert rows(dedup.latest_keep_null_keys(df, "k", "ts", ["i"]), "k", "i") == sorted(
        [("a", 1), (None, 3), (None, 4), ("b", 5)], key=repr
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=12))
def test_latest_properties(spark, data):
    df = spark.createDataFrame([(k, at(d), i) for i, (k, d) in enumerate(data)], FORM)
    once = dedup.latest_per_key(df, "k", "ts", ["i"])
    result = rows(once)
    assert len({r[0] for r in result}) == len(result) == len({k for k, _ in data})
    assert rows(dedup.latest_per_key(once, "k", "ts", ["i"])) == result
    kept = rows(dedup.latest_keep_null_keys(df, "k", "ts", ["i"]))
    assert sum(r[0] is None for r in kept) == sum(k is None for k, _ in data)


def test_latest_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 2 as string) as k", "timestamp_ntz'2025-01-01' as ts", "cast(id as int) as i")
    plan = dedup.latest_per_key(df, "k", "ts", ["i"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[exchange:]


def test_value_counts_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), (None, 2)], "k string, v int")
    assert [tuple(r) for r in profile.top_values(df, "k", 2).collect()] == [(None, 2), ("a", 2)]
    got = {r["metric"]: r["n"] for r in profile.duplicate_and_null_counts(df, ["k", "v"], ["k", "v"]).collect()}
    assert got == {"duplicates": 2, "nulls k": 2, "nulls v": 1, "rows": 5}
    empty = {r["metric"]: r["n"] for r in profile.duplicate_and_null_counts(df.limit(0), ["k"], ["v"]).collect()}
    assert empty == {"duplicates": 0, "nulls v": 0, "rows": 0}


def test_codebook(spark):
    data = [(str(i % 60), i, None if i < 2 else float(i)) for i in range(62)]
    df = spark.createDataFrame(data, "dni string, n int, x double")
    book = {r["variable"]: r for r in profile.codebook(df, key="dni", digits=1).collect()}
    assert book["dni"]["duplicates"] == "Sí (2 duplicados)"
    assert book["dni"]["sample"] == "(60 valores) Ej: 0, 1, 10, 11, 12"
    assert (book["n"]["duplicates"], book["n"]["minimum"], book["n"]["maximum"]) == ("No", 0.0, 61.0)
    # Two nulls repeat each other.
    assert (book["x"]["nulls"], book["x"]["null_percent"], book["x"]["duplicates"]) == (2, 3.2, "Sí")
    unique = {r["variable"]: r for r in profile.codebook(df.limit(5), key="n", sample="five").collect()}
    assert unique["n"]["duplicates"] == "No (PK válida)"
    assert unique["n"]["sample"] == "0, 1, 2, 3, 4"
    simple = profile.codebook(df, min_max=False, duplicates=False, sample=None)
    plan = profile.codebook(df)
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()
    assert simple.columns == ["variable", "type", "nulls", "null_percent", "distinct_values"]
    sketch = {r["variable"]: r["distinct_values"] for r in profile.codebook(df, approximate=True).collect()}
    assert abs(sketch["dni"] - 60) <= 6


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("z", 30)], "k string, r int")
    assert rows(joins.join_null_safe(left, right, ["k"]), "l", "r") == [(1, 10), (2, 20)]
    assert len(rows(joins.join_null_safe(right, left, ["k"], "left"))) == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_null_safe_join_spreads_null_keys(spark, how):
    left = spark.range(400).selectExpr("if(id % 2 = 0, null, id % 20) as k", "if(id % 3 = 0, null, 'x') as k2", "id as l")
    right = spark.createDataFrame([(None, None, 1), (None, "x", 2), (1, "x", 3), (3, None, 4), (77, "x", 5)], "k long, k2 string, r int")
    got = rows(joins.join_null_safe(left, right, ["k", "k2"], how), "k", "k2", "l", "r")
    table = {(r["k"], r["k2"]): r["r"] for r in right.collect()}
    expected = []
    for r in left.collect():
        found = table.get((r["k"], r["k2"]))
        if found is not None or how == "left":
            expected.append((r["k"], r["k2"], r["l"], found))
    assert got == sorted(expected, key=repr)
    spread = joins.join_null_safe(left, right, ["k", "k2"], how)._jdf.queryExecution().executedPlan().toString()
    assert "_l_salt" in spread


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_same_rows_with_and_without_broadcast(spark, how):
    # One key holds a third of the rows.
    big = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id % 50) as k", "id")
    small = spark.range(40).selectExpr("id as k", "id * 2 as twice")
    direct = joins.join_lookup(big, small, ["k"], how)
    salted = joins.join_lookup(big, small, ["k"], how, rows=0)
    assert "BroadcastHashJoin" in direct._jdf.queryExecution().executedPlan().toString()
    assert rows(direct, "k", "id", "twice") == rows(salted, "k", "id", "twice")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = joins.join_lookup(big, small, ["k"], how, rows=0)
        assert "_salt" in shuffled._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1]
        assert rows(direct, "k", "id", "twice") == rows(shuffled, "k", "id", "twice")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("salted_rows", [100, 0])
def test_lookup_beyond_the_bound_is_never_broadcast(spark, monkeypatch, tmp_path, salted_rows):
    # The file is far below Spark's own threshold, as a compact lookup of a million rows is.
    monkeypatch.setattr(joins, "SALTED_ROWS", salted_rows)
    spark.range(40).selectExpr("id as k", "id * 2 as twice").write.parquet(str(tmp_path / "lookup"))
    big = spark.range(3000).selectExpr("id % 50 as k", "id")
    out = joins.join_lookup(big, spark.read.parquet(str(tmp_path / "lookup")), ["k"], rows=10)
    assert out.count() == 2400
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_equivalence_and_value_transfer(spark):
    df = spark.createDataFrame([("M", "C1"), ("M", "C9")], "a string, c string")
    table = spark.createDataFrame([(" M ", "C1 ", "texto "), (None, "C9", "x")], "a string, c string, t string")
    assert rows(joins.with_equivalence(df, table, ["a", "c"]), "c", "t") == [("C1", "texto"), ("C9", None)]
    source = spark.createDataFrame([("M",), ("M",), (None,)], "name string")
    assert joins.keep_values_of(df, "a", source, "name").count() == 2


def test_group_total_back_skips_null_groups(spark):
    df = spark.createDataFrame([("s", "g", 1.0), ("s", "g", 2.0), (None, "g", 5.0)], "s string, g string, h double")
    got = rows(joins.group_total_back(df, ["s", "g"], "h", "t"), "s", "h", "t")
    assert got == sorted([("s", 1.0, 3.0), ("s", 2.0, 3.0), (None, 5.0, None)], key=repr)


@pytest.mark.parametrize("block", [1, 3, 100])
def test_backfill_any_block_size(spark, block):
    data = [("a", i, {2: "x", 7: "y"}.get(i)) for i in range(10)] + [(None, 0, None), (None, 4, "z")]
    df = spark.createDataFrame(data, "p string, i int, v string")
    got = {(r["p"], r["i"]): r["f"] for r in reshape.backfill(df, ["p"], "i", "v", "f", block).collect()}
    assert [got[("a", i)] for i in range(10)] == ["x"] * 3 + ["y"] * 5 + [None] * 2
    assert got[(None, 0)] == "z" and len(got) == 12


def test_unpivots(spark):
    wide = spark.createDataFrame([("1", "A", None, "3", "2", "67%", "z")], "DNI string, `2025-03-04` string, `5/3/2025` string, E string, R string, P string, extra string")
    long = reshape.unpivot_dates(wide, ["DNI"], ["2025-03-04", "5/3/2025"])
    assert rows(long, "fecha", "asistencia", "% DE PARTICIPACIÓN") == [
        (dt.date(2025, 3, 4), "A", "67%"),
        (dt.date(2025, 3, 5), None, "67%"),
    ]
    df = spark.createDataFrame([("1", 5.0, 6.0, "A", "B"), (None, 1.0, 2.0, "C", "D")], "id string, s1 double, s2 double, n1 string, n2 string")
    joined = reshape.unpivot_join(df, ["id"], {"s1": "C1", "s2": "C2"}, {"n1": "C1", "n2": "C2"}, "c", "s", "n")
    paired = reshape.unpivot_pairs(df, ["id"], {"C1": ("s1", "n1"), "C2": ("s2", "n2")}, "c", "s", "n")
    assert rows(joined, "id", "c", "s", "n") == rows(paired, "id", "c", "s", "n")
    twice = df.unionByName(df)
    fanned = reshape.unpivot_join(twice, ["id"], {"s1": "C1"}, {"n1": "C1"}, "c", "s", "n")
    assert fanned.count() == 8


def test_expand_and_replicate(spark):
    df = spark.createDataFrame([("P", 1), ("Q", 2)], "g string, i int")
    assert rows(reshape.expand_values(df, "g", {"P": ("1", "2")}, "d"), "i", "d") == [(1, "1"), (1, "2"), (2, "Q")]
    assert rows(reshape.replicate_value(df, "g", "P", ["x", "y", "z"]), "i", "g") == [(1, "x"), (1, "y"), (1, "z"), (2, "Q")]


def test_union_years(spark):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("y", "2")], "b string, id string")
    out = combine.union_years({"2025": a, "2026": b})
    assert out.columns == ["id", "a", "ANIO_FUENTE", "b"]
    assert rows(out) == sorted([("1", "x", "2025", None), ("2", None, "2026", "y")], key=repr)
    assert "ANIO_FUENTE" not in combine.union_years({"2025": a}, keep_year_tag=False).columns
    with pytest.raises(ValueError):
        combine.union_aligned([])


def test_schema_helpers(spark):
    df = spark.createDataFrame([("1", "x", None)], "a string, TEMA string, TEMAS string")
    out = schema.project(df, {"a": "A", "zzz": "B", "TEMA": "C"}, {"A": "double", "C": "double"})
    assert rows(out) == [(1.0, None, None)] and out.columns == ["A", "B", "C"]
    assert schema.rename_synonyms(df, {"T": ("TEMAS", "TEMA")}).columns == ["a", "T"]
    assert values(schema.rename_synonyms(df, {"T": ("TEMAS", "TEMA")}), "T") == ["x"]
    assert schema.add_suffix(df.withColumnRenamed("a", "a__c")).columns == ["a__c", "TEMA__c", "TEMAS__c"]
    assert schema.find_column(["N° DNI", "Apellido  Paterno"], r"\bpaterno\b") == "Apellido  Paterno"
    assert schema.find_named(["CONDICION_ACTUAL"], "Condición actual") == "CONDICION_ACTUAL"
    kept, unknown = schema.keep_known(df, ["a"])
    assert kept.columns == ["a"] and unknown == ["TEMA", "TEMAS"]
    assert schema.drop_if_present(df, ["a", "nada"]).columns == ["TEMA", "TEMAS"]


def test_api_names_follow_the_field_rule():
    titles = [
        "Dirección de correo electrónico",
        "Nombres del niño/a",
        "En caso de haber seleccionado celular ¿qué operador tiene?",
        "¿Con cuántas personas vive el niño/a? (Sin contar al niño/a)",
        "Apellido paterno",
        "Apellido paterno ",
        "N DE DOC. PRESENTADOS",
        "YA__c",
    ]
    assert list(schema.api_names(titles).values()) == [
        "Direccin_de_correo_electrnico__c",
        "Nombres_del_nioa__c",
        "En_caso_de_haber_seleccionado_celular_q__c",
        "Con_cuntas_personas_vive_el_nioa_S__c",
        "Apellido_paterno__c",
        "Apellido_paterno_1__c",
        "N_DE_DOC_PRESENTADOS__c",
        "YA__c",
    ]


def test_null_safe_join_with_and_without_spread(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 11), ("a", 12)], "k string, y int")
    want = {
        "inner": sorted([(None, 1, 10), (None, 2, 10), ("a", 3, 11), ("a", 3, 12)], key=repr),
        "left": sorted([(None, 1, 10), (None, 2, 10), ("a", 3, 11), ("a", 3, 12), ("b", 4, None)], key=repr),
    }
    for how, expected in want.items():
        for spread in (True, False):
            assert rows(joins.join_null_safe(left, right, ["k"], how, spread)) == expected
    plan = joins.join_null_safe(left, right, ["k"], "left", False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "xxhash64" not in plan
