"""Pages in one pass, distinct counts from stored bits, merged survey fields."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aulario.operators import bitmaps, fused
from aulario.operators.measures import FilterContext
from aulario.plans import dashboard as D
from aulario.plans import page
from aulario.plans.load import prepare_load
from tests.conftest import rows

SETTINGS = D.Settings(cuts={1: dt.date(2025, 4, 10), 2: dt.date(2025, 5, 20), 3: dt.date(2025, 4, 1), 4: None})
ATTENDANCE = "DNI__c string, FECHA__c date, ASISTENCIA__c string, TIPO_ALUMNO__c string, A_REALES__c double, A_ESPERADAS__c double, F_INCORPORACION__c date, CENTRO__c string"
GRADES = "DNI__c string, REA__c string, Valor_Promedio__c double, EVALUACION__c string, Competencia_texto__c string, CENTRO__c string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(6)
    day = lambda: rng.choice([None, dt.date(2025, 3, 1) + dt.timedelta(days=rng.randint(0, 100))])
    child = lambda: rng.choice([None, *map(str, range(30))])
    site = lambda: rng.choice([None, "A", "B", "C"])

    def attendance():
        return [
            (child(), day(), rng.choice(["A", "F", "FJ", None]), rng.choice(["ACTIVO", "INACTIVO", "OTRO", None]),
             rng.choice([None, 0.0, 5.0, 9.0]), rng.choice([None, 0.0, 10.0, 12.0]), day(), site())
            for _ in range(600)
        ]

    areas = ["Matemática", "Comunicación", "Tecnología", "Ciencia y Tecnología", None]
    grades = [
        (child(), rng.choice(areas), rng.choice([None, 11.0, 15.0, 18.0]), rng.choice(["2025-I", "2025-II", None]), rng.choice([None, "C1"]), site())
        for _ in range(400)
    ]
    base = tmp_path_factory.mktemp("facts")
    out = {}
    for name, data, schema in (("attendance", attendance(), ATTENDANCE), ("extra", attendance(), ATTENDANCE), ("grades", grades, GRADES)):
        spark.createDataFrame(data, schema).write.parquet(str(base / name))
        out[name] = spark.read.parquet(str(base / name))
    return out


NUMBERS = [n for n, (b, _) in D.MEASURES.items() if b.build in page.RECIPES]


def rounded(df):
    number = F.round(F.col("value").try_cast("double"), 9).cast("string")
    return rows(df.withColumn("value", F.coalesce(number, "value")), *sorted(df.columns))


@pytest.mark.parametrize("by", [(), ("CENTRO__c",)])
@pytest.mark.parametrize("filtered", [False, True])
def test_page_equals_single_blocks(tables, by, filtered):
    filters = {"FECHA__c": lambda c: c >= dt.date(2025, 4, 5), "CENTRO__c": lambda c: c != "B"} if filtered else {}
    ctx = FilterContext(by, filters)
    assert len(NUMBERS) == 57 and {b.build for b in D.BLOCKS if b.build in page.RECIPES} == set(page.RECIPES)
    assert rounded(page.evaluate_page(NUMBERS, tables, ctx, SETTINGS)) == rounded(D.evaluate(NUMBERS, tables, ctx, SETTINGS))


def test_page_of_empty_tables(tables):
    empty = {n: t.limit(0) for n, t in tables.items()}
    for by in ((), ("CENTRO__c",)):
        ctx = FilterContext(by)
        assert rounded(page.evaluate_page(NUMBERS, empty, ctx, SETTINGS)) == rounded(D.evaluate(NUMBERS, empty, ctx, SETTINGS))


def test_one_scan_per_table(tables):
    ctx = FilterContext(("CENTRO__c",), {"FECHA__c": lambda c: c >= dt.date(2025, 4, 5)})
    blocks = [b for b in D.BLOCKS if b.build in page.RECIPES]
    for name, df in tables.items():
        keys, ingredients = page.page_ingredients(name, df, blocks, ctx, SETTINGS)
        plan = fused.gather_plan(df, ctx.by, keys, ingredients)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    # What is left to do reads the gathered rows, never the tables.
    last = page.evaluate_page(NUMBERS, tables, ctx, SETTINGS)
    assert not any("/facts" in f for f in last.inputFiles())


def test_page_mixes_recipes_and_blocks(tables):
    numbers = ["1.1", "3.3", "2.1"]
    more = {**tables, "grades": tables["grades"].withColumn("NIVEL_DE_LOGRO__c", F.col("REA__c"))}
    assert rounded(page.evaluate_page(numbers, more)) == rounded(D.evaluate(numbers, more))


def dims():
    return {"site": F.col("CENTRO__c"), "day": F.col("FECHA__c"), "status": F.col("TIPO_ALUMNO__c")}


def test_stored_bits_give_every_distinct_count(tables):
    df = tables["attendance"]
    numbers = bitmaps.number_keys(df, "DNI__c", ["CENTRO__c"])
    assert numbers.count() == 30 == numbers.select("id").distinct().count()
    store = bitmaps.key_bitmaps(df, "DNI__c", dims(), numbers)
    for by in ([], ["site"], ["status"], ["site", "day"]):
        conditions = {
            "n": F.lit(True),
            "active": F.col("status") == "ACTIVO",
            "to_cut": (F.col("day") <= dt.date(2025, 4, 10)) & F.col("status").isin("ACTIVO", "INACTIVO"),
            "none": F.col("status") == "nobody",
        }
        ctx = FilterContext(tuple(by))
        named = df.select("DNI__c", *[c.alias(n) for n, c in dims().items()])
        want = D.M.distinct_counts(named, ctx, "DNI__c", **conditions)
        assert rows(bitmaps.count_keys(store, by, **conditions), *want.columns) == rows(want)
    assert rows(bitmaps.count_keys(store.limit(0), n=F.lit(True))) == [(0,)]


def test_bits_of_two_loads_are_united(tables):
    df = tables["attendance"]
    old, new = df.filter("FECHA__c < '2025-04-10'"), df.filter("not coalesce(FECHA__c < '2025-04-10', false)")
    some = old.filter("DNI__c > '2' or DNI__c is null")
    first = bitmaps.number_keys(some, "DNI__c")
    numbers = bitmaps.number_keys(df, "DNI__c", known=first)
    assert rows(numbers.join(first, ["key", "id"], "left_semi")) == rows(first) and numbers.count() == 30
    assert numbers.select("id").distinct().count() == 30
    stores = [bitmaps.key_bitmaps(d, "DNI__c", dims(), numbers) for d in (old, new, new)]
    whole = bitmaps.key_bitmaps(df, "DNI__c", dims(), numbers)
    both = bitmaps.united(stores, list(dims()))
    for by in ([], ["site"]):
        assert rows(bitmaps.count_keys(both, by, n=F.lit(True))) == rows(bitmaps.count_keys(whole, by, n=F.lit(True)))


def test_second_asking_of_a_survey_question(spark):
    question = "Considero que la cantidad de días que mi(s) hijo(s) fueron al Programa fueron los adecuados "
    df = spark.createDataFrame([("1", "a", "b", None), ("2", "c", None, "d")], ["N Documento Niño", question, question + ".1", question + " 2"])
    found = prepare_load(df, "parent_survey")
    first, second = "Considero_que_la_cantidad_de_das_que_mi__c", "Considero_que_la_cantidad_de_das_que_m_1__c"
    assert rows(found, "N_de_documento_1__c", first, second) == [("1", "a", "b"), ("2", "c", "d")]
    assert len(found.columns) == 3
    alone = prepare_load(df.drop(question + " 2"), "parent_survey")
    assert rows(alone, first, second) == [("a", "b"), ("c", None)]
