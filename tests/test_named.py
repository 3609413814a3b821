"""Records by heading against the wide table, and many headings without a list in the driver."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from aulario.operators import grid, named
from aulario.plans.enrolment import enrolment, enrolment_records
from tests.conftest import rows
from tests.test_entities import both
from tests.test_grid import sheet

HEAD = ["DNI", "GRADO", "CONDICIÓN ACTUAL", "FECHA DE REGISTRO"]


def three_sheets(spark):
    lines = [[None]] * 4 + [HEAD, ["1.0", "1er grado", "Inactivo", "agosto"], ["DNI 2", *HEAD[1:]], [None, "x", "y", "z"]]
    wider = [[None]] * 4 + [[*HEAD, "EXTRA", "OTRA"], ["3", "otro", "RETIRADO", "2025-03-04", "e", None], ["6", None, None, None, None, "o"]]
    renamed = [[None]] * 4 + [["DNI", "GRADO", "ESTADO", "FECHA DE REGISTRO"], ["4", None, "activo", "#N/A"], ["5", "x", "otra", "4/3/2025"]]
    return both(
        sheet(spark, lines, "01 A", first_col=2), sheet(spark, wider, "02 B", first_col=2), sheet(spark, renamed, "03 C", first_col=2)
    )


@pytest.mark.parametrize("exact", [True, False])
def test_records_equal_the_wide_table(spark, exact):
    wide = enrolment(three_sheets(spark), 2026, exact)
    names, records = enrolment_records(three_sheets(spark), 2026, exact)
    titles = [r.header for r in names.orderBy("position").collect()]
    assert ["HOJA_ORIGEN", *titles] == wide.columns
    got = named.columns_of(records.withColumnRenamed("sheet", "HOJA_ORIGEN"), titles, ["HOJA_ORIGEN"])
    as_text = wide.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns])
    assert rows(got, *wide.columns) == rows(as_text, *wide.columns) and got.count() == 5


def test_layout_equals_the_lists(spark):
    cells = three_sheets(spark)
    titles = grid.fixed_header_cells(cells, 4, 2)
    base, extra = grid.common_layout(titles)
    names, headers = named.named_layout(titles)
    found = names.orderBy("position").collect()
    assert [r.header for r in found] == [*base, *extra] and [r.position for r in found] == list(range(len(found)))
    assert [r.header for r in found if r.base] == base
    renamed = grid.duplicate_headers(grid.positional_headers(titles, base))
    assert rows(headers, *titles.columns) == rows(renamed, *titles.columns)


def test_nothing(spark):
    cells = three_sheets(spark).limit(0)
    names, records = enrolment_records(cells, 2026)
    assert names.count() == 0 and records.count() == 0
    assert named.headings_named(names, {}) == {}


def test_numbers_follow_the_order_over_many_ranges(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x")).repartition(7)
    assert named.numbered(df, "x").filter("position != x").count() == 0
    assert named.numbered(df.limit(0), "x").count() == 0


def test_a_hundred_thousand_headings_and_none_in_the_driver(spark, monkeypatch):
    # Five sheets, two of the same width; every heading but one occurs in one sheet only.
    width = F.lit(26_000) - F.greatest(F.col("s"), F.lit(1))
    place = spark.range(5).withColumnRenamed("id", "s").select("s", F.explode(F.sequence(F.lit(2), width + 1)).alias("col"))
    title = F.when(F.col("col") == 2, F.lit("DNI")).otherwise(F.concat_ws(" ", F.lit("H"), "s", "col"))
    value = F.concat("row", F.lit("0"), "col")
    line = place.select("s", "col", F.explode(F.sequence(F.lit(4), F.lit(6))).alias("row"))
    cells = line.select(
        F.lit("f").alias("file"), F.concat(F.lit("0"), F.col("s").cast("string"), F.lit(" X")).alias("sheet"),
        F.col("row").cast("int"), F.col("col").cast("int"), F.when(F.col("row") == 4, title).otherwise(value).alias("value"),
    )
    sizes = []
    collect = DataFrame.collect

    def counted(self):
        found = collect(self)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(DataFrame, "collect", counted)
    names, records = enrolment_records(cells, 2026)
    total = records.agg(F.sum(F.size("fields")).alias("n"), F.count(F.lit(1)).alias("r")).first()
    widths = [25_999, 25_999, 25_998, 25_997, 25_996]
    assert (total["n"], total["r"]) == (2 * sum(widths), 10)
    assert names.count() == 1 + sum(w - 1 for w in widths) - (widths[1] - 1) > 100_000
    assert names.agg(F.max("position")).first()[0] == names.count() - 1 and max(sizes) <= 5
    # The second sheet has the common width, so its values stand under the first one's headings.
    assert named.columns_of(records, ["H 0 9"]).filter("`H 0 9` is not null").count() == 4
