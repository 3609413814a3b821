import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from aulario.functions import dates, ids, mapping, numbers, text
from aulario.plans import constants as K
from aulario.plans.skills import level_order


def apply(spark, values, change, kind="string"):
    """Result of a column function over single values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", change(F.col("v")).alias("out")).orderBy("i").collect()]


def test_accent_fold_equals_unicode_tables(spark):
    """Every character of the first two planes, against the Unicode data itself."""
    texts = [chr(p) + "x" + chr(p) for p in range(1, 0x20000) if not 0xD800 <= p <= 0xDFFF]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", text.strip_accents(F.col("t")).alias("plain")).collect():
        assert row["plain"] == unicodedata.normalize("NFKD", row["t"]).encode("ascii", "ignore").decode()


def test_norm_key_and_text(spark):
    assert apply(spark, ["  ÁREA–N°\t1 ", "a_b (c)", None, ""], text.norm_key) == ["arean 1", "a_b c", "", ""]
    assert apply(spark, [" Condición  actual ", None], text.norm_text) == ["CONDICION ACTUAL", None]
    assert apply(spark, ["ñandú rojo"], text.norm_text) == ["NANDU ROJO"]
    assert apply(spark, ["Fecha_de  registro"], text.norm_label) == ["FECHA DE REGISTRO"]
    assert apply(spark, ["\tDNI ( * )\n*", None], text.clean_header) == ["DNI", ""]


def test_clean_cell_and_null_tokens(spark):
    assert apply(spark, [" a;\n b\t\tc ", "x"], text.clean_cell) == ["a b c", "x"]
    assert apply(spark, ["#N/A", "nan", "ok"], lambda c: text.null_tokens(c, K.EXCEL_ERRORS)) == [None, "nan", "ok"]
    assert apply(spark, ["  ", "a "], text.blank_to_null) == [None, "a"]


def test_status_words(spark):
    raw = ["Activo", "RETIRADO", "Inactivo", "retirado (activo)", "otro", None]
    assert apply(spark, raw, text.contains_status) == ["ACTIVO", "INACTIVO", "INACTIVO", "INACTIVO", None, None]
    by_fragment = apply(spark, raw, lambda c: text.contains_status(c, exact=False))
    assert by_fragment == ["ACTIVO", "INACTIVO", "ACTIVO", "INACTIVO", None, None]


def test_keyword_categories_in_order(spark):
    raw = ["ninguna", "retardo en lenguaje", "TDH", "autismo", "vista baja", "cadera", "asma", " ", None]
    out = apply(
        spark,
        raw,
        lambda c: text.keyword_category(c, K.DISABILITY_WHOLE, K.DISABILITY_WORDS, K.DISABILITY_OTHER),
    )
    assert out == ["NINGUNA", "LENGUAJE", "APRENDIZAJE", "TEA", "VISUAL", "FISICA", "OTRO", None, None]


def test_full_name(spark):
    df = spark.createDataFrame([("Ana  María", "Pérez", "Ruiz"), ("X", "X", None), ("Y", "Soto, Y", None)], "n string, a string, b string")
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    three = [r[0] for r in df.select(text.full_name(n, a, b)).collect()]
    two = [r[0] for r in df.select(text.full_name(n, a)).collect()]
    assert three[0] == "Pérez Ruiz, Ana María"
    assert two[1:] == ["X", "Soto, Y"]


def test_names_from_files_and_headers(spark):
    assert apply(spark, ["01 SEDE - X - Y.xlsx", "sin.xlsx"], text.centre_before_dash) == ["01 SEDE", "sin.xlsx"]
    assert apply(spark, ["TALLERES_A_B REGISTRO 2025.xlsm"], lambda c: text.centre_from_file(c, "TALLERES_", [" REGISTRO 2025"], True)) == ["A B"]
    assert apply(spark, ["PROMEDIO C12", "DNI"], text.capture_code) == ["C12", None]
    heads = apply(spark, ["2025-01-02 - a - b", "solo"], lambda c: text.split_two(c)[0])
    tails = apply(spark, ["2025-01-02 - a - b", "solo"], lambda c: text.split_two(c)[1])
    assert (heads, tails) == (["2025-01-02", "solo"], ["a - b", None])
    assert apply(spark, ["PACHACÚTEC"], lambda c: text.substring_at(c, 7)) == ["Ú"]


def test_ids(spark):
    raw = ["79952505.0", "79952505", " 7-99.0 ", "abc", "", None, "0", "1.50"]
    assert apply(spark, raw, ids.document_id) == ["79952505", "79952505", "7990", None, None, None, "0", "150"]
    assert apply(spark, ["0", "0.0", "10"], lambda c: ids.document_id(c, ["0"])) == [None, None, "10"]
    assert apply(spark, ["79952505.0", "x"], ids.digits) == ["799525050", None]


def test_code_tables(spark):
    assert apply(spark, ["M", "Z", None], lambda c: mapping.map_or_keep(c, K.SEX_REGULAR)) == ["FEMENINO", "Z", None]
    assert apply(spark, ["M"], lambda c: mapping.map_or_keep(c, K.SEX_EXTRA)) == ["MASCULINO"]
    assert apply(spark, ["CUSCO", "OTRA", None], lambda c: mapping.map_or_null(c, K.SITE_CODES)) == ["05 CUSCO", None, None]
    assert apply(spark, ["Logrado ", "EN PROCESO", "En Início", "sobresaliente", "x", None], level_order) == [3, 2, 1, 4, None, None]


def test_numbers(spark):
    assert apply(spark, [" 1.5 ", "x", None, "1e3"], numbers.to_number) == [1.5, None, None, 1000.0]
    assert apply(spark, ["85.5%", "%", None], numbers.percent_to_double) == [85.5, None, None]
    df = spark.createDataFrame([(4, 2), (4, 0), (4, None), (None, 2)], "a int, b int")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(numbers.divide(a, b)).collect()] == [2.0, None, None, None]
    assert [r[0] for r in df.select(numbers.divide(a, b, 0)).collect()] == [2.0, 0.0, 0.0, None]
    assert [r[0] for r in df.select(numbers.change(b, a)).collect()] == [1.0, None, None, -1.0]


def test_labels(spark):
    df = spark.createDataFrame([(1234, 0.1255), (0, None)], "n bigint, p double")
    n, p = F.col("n"), F.col("p")
    assert [r[0] for r in df.select(numbers.count_percent(n, p)).collect()] == ["1234 (12.6%)", "0 ()"]
    assert [r[0] for r in df.select(numbers.count_percent(n, p, thousands=True)).collect()][0] == "1,234 (12.6%)"
    assert [r[0] for r in df.select(numbers.percent_count(p, n, "niños")).collect()][0] == "12.6%  (1,234 niños)"
    assert [r[0] for r in df.select(numbers.blank_to(p, 0.0)).collect()] == [0.1255, 0.0]


D = dt.date


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("2025-03-04", D(2025, 3, 4)),
        ("2025-03-24 10:11:12", D(2025, 3, 24)),
        ("2025-03-04T10:11:12.5", D(2025, 3, 4)),
        ("04/03/2025", D(2025, 3, 4)),
        ("4-3-2025 8:05", D(2025, 3, 4)),
        ("4.3.25", D(2025, 3, 4)),
        ("31/02/2025", None),
        ("03/25/2025", None),
        ("45000", D(2023, 3, 15)),
        ("45000.75", D(2023, 3, 15)),
        ("20000", None),
        ("60000", None),
        ("mar", None),
        ("abr", None),
        ("", None),
        (None, None),
        ("GRADO", None),
    ],
)
def test_date_like(spark, raw, expected):
    assert apply(spark, [raw], dates.date_like) == [expected]


def test_serial_fraction(spark):
    assert apply(spark, ["45000.5"], dates.from_serial) == [dt.datetime(2023, 3, 15, 12)]


def test_vague_months(spark):
    raw = ["agosto", " Set24", "abr - ago", "ABR", "4/3/2025", "2025-03-04", "<NA>", "luego", None]
    out = apply(spark, raw, lambda c: dates.month_word_date(c, 2026, K.MONTH_WORDS, K.MONTH_WORDINGS))
    assert out == [D(2026, 8, 1), D(2024, 9, 1), D(2026, 4, 1), D(2026, 4, 1), D(2025, 3, 4), D(2025, 3, 4), None, None, None]


def test_ages_and_months(spark):
    as_of = F.lit("2025-06-30").cast("date")
    births = [D(2015, 6, 30), D(2015, 7, 1), D(2025, 6, 30), None]
    assert apply(spark, births, lambda c: dates.age_years(c, as_of), "date") == [10, 9, 0, None]
    assert apply(spark, [D(2024, 2, 10)], dates.month_start, "date") == [D(2024, 2, 1)]
    assert apply(spark, [D(2024, 2, 10)], dates.month_end, "date") == [D(2024, 2, 29)]
    assert apply(spark, [D(2024, 2, 10)], dates.month_name, "date") == ["February"]
    assert apply(spark, [D(2024, 2, 10)], dates.day_first_text, "date") == ["10/02/2024"]
    assert apply(spark, ["de 2019 a 2021", "x", None, "123456789"], dates.largest_year) == [2021, None, None, 5678]
