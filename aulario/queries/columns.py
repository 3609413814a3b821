"""Queries over column functions: text, ids, code tables, numbers, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulario.functions import dates, ids, mapping, numbers, text
from aulario.operators.grid import is_repeated_header
from aulario.plans import constants as K
from aulario.plans.skills import level_order
from aulario.queries.register import Registry, table

REGISTRY = Registry()
query = REGISTRY.query

# White space as the SQL side's regular expressions spell it.
_WS = r"[\t\n\x0B\f\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_FOLD = r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"

# --- text --------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_FOLD} AS plain FROM documents")
def strip_accents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query(
    rf"""SELECT doc_id, lower(trim(regexp_replace(regexp_replace({_FOLD}, '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS clave
    FROM documents"""
)
def norm_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.norm_key(F.col("text")).alias("clave"))


@query(
    rf"""SELECT doc_id, upper(trim(regexp_replace({_FOLD}, '{_WS}+', ' ', 'g'))) AS texto,
      upper(trim(regexp_replace(regexp_replace({_FOLD}, '_', ' ', 'g'), '{_WS}+', ' ', 'g'))) AS etiqueta FROM documents"""
)
def norm_text(spark, sf):
    c = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", text.norm_text(c).alias("texto"), text.norm_label(c).alias("etiqueta")
    )


@query(
    rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\n\r\t;]+', ' ', 'g'), '{_WS}+', ' ', 'g')) AS limpio
    FROM documents"""
)
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_cell(F.col("text")).alias("limpio"))


@query(
    r"""SELECT p_partkey, upper(p_name) || ' ' || p_partkey AS titulo FROM part"""
)
def clean_header(spark, sf):
    raw = F.concat(F.lit(" "), "p_name", F.lit("( * )\n\t*"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(" \r"))
    return table(spark, sf, "part").select("p_partkey", text.clean_header(raw).alias("titulo"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN NULL ELSE o_orderpriority END AS valor
    FROM orders"""
)
def null_tokens(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text.null_tokens(F.col("o_orderpriority"), ["5-LOW", "1-URGENT"]).alias("valor")
    )


@query(
    """SELECT p_partkey, CASE WHEN p_brand LIKE '%1%' THEN p_name || ' ' || p_type || ', ' || p_brand
      WHEN p_brand LIKE '%2%' THEN p_name WHEN p_brand LIKE '%3%' THEN p_name || ', ' || p_type
      ELSE p_type || ', ' || p_brand END AS nombre FROM part"""
)
def full_name(spark, sf):
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    spaced = F.concat(F.lit("  "), kind, F.lit(" "))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(brand.contains("1"), text.full_name(brand, name, kind))
        .when(brand.contains("2"), text.full_name(name, name))
        .when(brand.contains("3"), text.full_name(brand, F.concat(name, F.lit(",  "), kind)))
        .otherwise(text.full_name(brand, spaced))
        .alias("nombre"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'ACTIVO' WHEN '2-HIGH' THEN 'INACTIVO'
      WHEN '3-MEDIUM' THEN 'INACTIVO' END AS estado,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'ACTIVO' WHEN '2-HIGH' THEN 'ACTIVO' WHEN '3-MEDIUM' THEN 'INACTIVO' END
      AS estado_por_fragmento FROM orders"""
)
def contains_status(spark, sf):
    raw = mapping.map_or_null(
        F.col("o_orderpriority"),
        {"1-URGENT": "niño activo", "2-HIGH": "Inactivo", "3-MEDIUM": "Retirado (activo antes)", "5-LOW": "otro"},
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.contains_status(raw).alias("estado"),
        text.contains_status(raw, exact=False).alias("estado_por_fragmento"),
    )


@query(
    """SELECT doc_id, CASE WHEN t LIKE '%LICENSE%' THEN 'LICENCIA' WHEN t LIKE '%EMAIL%' OR t LIKE '%@%' THEN 'CONTACTO'
      WHEN t LIKE '%QUE%' OR t LIKE '%UND%' THEN 'LENGUAJE' ELSE 'OTRO' END AS categoria
    FROM (SELECT doc_id, upper(text) AS t FROM documents)"""
)
def keyword_category(spark, sf):
    words = {"LICENCIA": ("LICENSE",), "CONTACTO": ("EMAIL", "@"), "LENGUAJE": ("QUE", "UND")}
    documents = table(spark, sf, "documents").select("doc_id", text.strip(F.upper("text")).alias("t"))
    category = text.keyword_category(F.col("t"), {"NINGUNA": ("NADA",)}, words, "OTRO", prepared=True)
    return documents.select("doc_id", category.alias("categoria"))


@query(
    """SELECT n_nationkey, lpad(n_nationkey::VARCHAR, 2, '0') || ' ' || n_name AS antes_del_guion,
      replace(n_name, '_', ' ') AS de_archivo, n_name AS sin_prefijo FROM nation"""
)
def file_centre(spark, sf):
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    dashed = F.concat(code, F.lit(" "), "n_name", F.lit(" - ASISTENCIA - 2025.xlsx"))
    suffixed = F.concat("n_name", F.lit(" REGISTRO DE ASISTENCIA 2025.xlsx"))
    prefixed = F.concat(F.lit("TALLERES_"), "n_name", F.lit(" REGISTRO DE ASISTENCIA 2025.xlsm"))
    suffix = " REGISTRO DE ASISTENCIA 2025"
    return table(spark, sf, "nation").select(
        "n_nationkey",
        text.centre_before_dash(dashed).alias("antes_del_guion"),
        text.centre_from_file(suffixed, "", [suffix], underscores=True).alias("de_archivo"),
        text.centre_from_file(prefixed, K.EXTRA_FILE_PREFIX, [suffix]).alias("sin_prefijo"),
    )


@query(
    """SELECT page_id, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) AS sitio,
      nullif(regexp_extract(url, '(\\d+)\\?', 1), '') AS codigo, nullif(regexp_extract(html, '(C\\d+)', 1), '') AS competencia
    FROM pages""".replace("\\\\", "\\")
)
def code_extract(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.concat(F.split_part("url", F.lit("/"), F.lit(1)), F.lit("//"), F.split_part("url", F.lit("/"), F.lit(3))).alias("sitio"),
        text.capture_code(F.col("url"), r"(\d+)\?").alias("codigo"),
        text.capture_code(F.col("html")).alias("competencia"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN '2025-03-04' ELSE c_mktsegment END AS cabeza,
      CASE WHEN c_nationkey < 20 THEN c_name || ' - ' || c_mktsegment END AS cola FROM customer"""
)
def split_two(spark, sf):
    joined = F.when(
        F.col("c_nationkey") < 20, F.concat(F.lit("2025-03-04 - "), "c_name", F.lit(" - "), "c_mktsegment")
    ).otherwise(F.col("c_mktsegment"))
    head, tail = text.split_two(joined)
    return table(spark, sf, "customer").select("c_custkey", head.alias("cabeza"), tail.alias("cola"))


@query(
    """SELECT o_orderkey, (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)
      + (CASE WHEN o_custkey < 100 THEN 1 ELSE 0 END) >= 2 AS repetida FROM orders"""
)
def repeated_header_rows(spark, sf):
    values = F.array(
        F.when(F.col("o_orderstatus") == "F", "DNI").otherwise(F.col("o_orderstatus")),
        F.when(F.col("o_orderpriority") == "1-URGENT", "GRADO"),
        F.when(F.col("o_custkey") < 100, "SEXO").otherwise(F.lit("x")),
        F.lit("otro"),
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", is_repeated_header(["DNI", "GRADO", "SEXO", "CENTRO"], values).alias("repetida")
    )


# --- ids and codes -----------------------------------------------------------------------


@query(
    """SELECT c_custkey, nullif(regexp_replace(c_name, '\\D', '', 'g'), '') AS de_texto,
      nullif(c_custkey, 0)::VARCHAR AS de_numero, c_custkey::VARCHAR || '0' AS solo_digitos,
      NULL::VARCHAR AS sin_digitos FROM customer""".replace("\\\\", "\\")
)
def id_clean(spark, sf):
    number = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        ids.document_id(F.col("c_name")).alias("de_texto"),
        ids.document_id(number, K.ID_NULLS).alias("de_numero"),
        ids.digits(number).alias("solo_digitos"),
        ids.digits(F.col("c_mktsegment")).alias("sin_digitos"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FEMENINO' WHEN 'P' THEN 'PENDIENTE' ELSE o_orderstatus END AS v
    FROM orders"""
)
def map_keep(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", mapping.map_or_keep(F.col("o_orderstatus"), {"F": "FEMENINO", "P": "PENDIENTE"}).alias("v")
    )


@query("SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '01' WHEN 'STANDARD' THEN '02' END AS v FROM part")
def map_null(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", mapping.map_or_null(F.col("p_type"), {"ECONOMY": "01", "STANDARD": "02"}).alias("v")
    )


@query(
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
      WHEN '4-NOT SPECIFIED' THEN 1 END AS orden FROM orders"""
)
def level_order_codes(spark, sf):
    level = mapping.map_or_null(
        F.col("o_orderpriority"),
        {"1-URGENT": "Sobresaliente", "2-HIGH": " LOGRÁDO ", "3-MEDIUM": "En  proceso".replace("  ", " "),
         "4-NOT SPECIFIED": "EN INICIO", "5-LOW": "otro"},
    )
    return table(spark, sf, "orders").select("o_orderkey", level_order(level).alias("orden"))


# --- numbers -----------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS porcentaje, l_quantity AS numero,
      NULL::DOUBLE AS texto, round(l_tax / nullif(l_discount, 0), 9) AS razon,
      CASE WHEN l_discount = 0 THEN 0 ELSE round(l_tax / l_discount, 9) END::DOUBLE AS razon_cero FROM lineitem"""
)
def pct_to_double(spark, sf):
    percent = F.concat(F.col("l_discount").cast("string"), F.lit("%"))
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.percent_to_double(percent).alias("porcentaje"),
        numbers.to_number(F.concat(F.lit(" "), F.col("l_quantity").cast("string"))).alias("numero"),
        numbers.to_number(F.col("l_returnflag")).alias("texto"),
        F.round(numbers.divide(tax, discount), 9).alias("razon"),
        F.round(numbers.divide(tax, discount, 0), 9).alias("razon_cero"),
    )


@query(
    """SELECT o_orderkey, printf('%.1f%%', round((o_orderkey / 7.0::DOUBLE) * 100, 1)) AS porcentaje,
      format('{:,}', o_orderkey) || ' (' || printf('%.1f%%', round((o_orderkey / 7.0::DOUBLE) * 100, 1)) || ')' AS etiqueta
    FROM orders"""
)
def number_labels(spark, sf):
    ratio = F.col("o_orderkey") / F.lit(7.0)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        numbers.percent_label(ratio).alias("porcentaje"),
        numbers.count_percent(F.col("o_orderkey"), ratio, thousands=True).alias("etiqueta"),
    )


# --- dates -------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
      THEN o_orderdate + CASE WHEN o_orderpriority = '3-MEDIUM' THEN INTERVAL '8 hours 5 minutes 9 seconds'
        ELSE INTERVAL '0 seconds' END END AS momento,
      CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%d/%m/%Y') END AS texto FROM orders"""
)
def date_parse_mixed(spark, sf):
    d = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.date_format(d, "d-M-yyyy"), F.lit(" 8:05:09")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00")))
        .otherwise("31/02/2020")
    )
    stamp = dates.parse_timestamp(raw)
    return table(spark, sf, "orders").select(
        "o_orderkey", stamp.alias("momento"), dates.day_first_text(stamp).alias("texto")
    )


@query(
    """SELECT o_orderkey, o_orderdate + INTERVAL '6 hours' AS momento, cast(o_orderdate AS date) AS fecha,
      NULL::DATE AS no_fecha FROM orders"""
)
def serial_dates(spark, sf):
    serial = F.datediff(F.col("o_orderdate"), F.lit(dates.SERIAL_EPOCH).cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.from_serial(serial + F.lit(0.25)).alias("momento"),
        dates.date_like(serial.cast("string")).alias("fecha"),
        dates.date_like(F.concat(F.lit("mar"), F.col("o_orderstatus"))).alias("no_fecha"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date)
      WHEN o_orderpriority = '1-URGENT' THEN DATE '2024-09-01' WHEN o_orderpriority = '2-HIGH' THEN DATE '2025-04-01'
      WHEN o_orderpriority = '3-MEDIUM' THEN DATE '2025-08-01' END AS fecha FROM orders"""
)
def vague_month(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d/M/yyyy")).otherwise(
        mapping.map_or_null(
            F.col("o_orderpriority"),
            {"1-URGENT": "Set24", "2-HIGH": "abr - ago", "3-MEDIUM": " Agosto ", "5-LOW": "pronto"},
        )
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_word_date(raw, 2025, K.MONTH_WORDS, K.MONTH_WORDINGS).alias("fecha")
    )


@query(
    """SELECT o_orderkey, cast(trunc(date_diff('day', o_orderdate::DATE, DATE '2025-06-30') / 365.25) AS INTEGER) AS edad
    FROM orders"""
)
def age_years(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.age_years(F.col("o_orderdate"), F.lit("2025-06-30").cast("date")).alias("edad")
    )


@query(
    """SELECT o_orderkey, monthname(o_orderdate) AS mes, date_trunc('month', o_orderdate)::DATE AS inicio,
      last_day(o_orderdate) AS fin, strftime(o_orderdate, '%Y-%m') = '1998-10' AS mismo_mes,
      o_orderdate::DATE AS dia, strftime(o_orderdate, '%Y-%m-%d') AS texto FROM orders"""
)
def month_name(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.month_name(d).alias("mes"),
        dates.month_start(d).alias("inicio"),
        dates.month_end(d).alias("fin"),
        dates.same_month(d, F.lit("1998-10-20").cast("date")).alias("mismo_mes"),
        F.to_date(d).alias("dia"),
        dates.iso_text(d).alias("texto"),
    )


@query(
    """SELECT o_custkey, max(greatest(year(o_orderdate), 2000 + o_orderkey % 20))::INTEGER AS anio FROM orders GROUP BY o_custkey"""
)
def max_year(spark, sf):
    words = F.concat(
        F.lit("Ingreso "), F.date_format("o_orderdate", "yyyy"), F.lit(" / renueva "), (2000 + F.col("o_orderkey") % 20).cast("string")
    )
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max(dates.largest_year(words)).alias("anio"))
