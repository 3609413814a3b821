"""Queries over table operators: joins, set operations, dedup, profiles, reshaping, sinks' reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulario.operators import combine, dedup, joins, profile, profiles, reshape, schema
from aulario.plans.hours import with_yearly_hours
from aulario.queries.register import Registry, table
from aulario.sources.sinks import load_summary, top_errors
from aulario.sources.stages import stage

REGISTRY = Registry()
query = REGISTRY.query

# --- dedup -------------------------------------------------------------------------------

_FORM = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS doc,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS marca, o_orderkey, o_totalprice FROM orders"""


def _form(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "case when o_orderpriority = '5-LOW' then null else o_custkey end as doc",
        "case when o_orderstatus = 'P' then null else o_orderdate end as marca",
        "o_orderkey",
        "o_totalprice",
    )


@query(
    f"""SELECT doc, marca, o_orderkey, o_totalprice FROM ({_FORM})
    QUALIFY row_number() OVER (PARTITION BY doc ORDER BY marca DESC NULLS FIRST, o_orderkey DESC) = 1"""
)
def latest_per_key_null_wins(spark, sf):
    return dedup.latest_per_key(_form(spark, sf), "doc", "marca", ["o_orderkey"])


@query(
    f"""SELECT doc, marca, o_orderkey, o_totalprice FROM ({_FORM})
    QUALIFY doc IS NULL OR row_number() OVER (PARTITION BY doc ORDER BY marca DESC NULLS LAST, o_orderkey DESC) = 1"""
)
def latest_keep_nulls(spark, sf):
    return dedup.latest_keep_null_keys(_form(spark, sf), "doc", "marca", ["o_orderkey"])


# --- profiles ----------------------------------------------------------------------------


@query(
    """SELECT v AS event_type, count(*) AS n FROM (SELECT CASE WHEN event_type = 'view' AND value > 50 THEN NULL
    ELSE event_type END AS v FROM events) GROUP BY v ORDER BY n DESC, v NULLS FIRST LIMIT 3"""
)
def topk_counts(spark, sf):
    marks = table(spark, sf, "events").selectExpr(
        "case when event_type = 'view' and value > 50 then null else event_type end as event_type"
    )
    return profile.top_values(marks, "event_type", 3)


@query(
    """WITH t AS (SELECT l_partkey, l_suppkey, nullif(l_returnflag, 'A') AS flag, nullif(l_linestatus, 'O') AS estado
      FROM lineitem), k AS (SELECT count(*) AS n FROM t GROUP BY l_partkey, l_suppkey)
    SELECT 'duplicates' AS metric, cast(sum(n - 1) AS BIGINT) AS n FROM k
    UNION ALL SELECT 'nulls flag', count(*) FILTER (WHERE flag IS NULL) FROM t
    UNION ALL SELECT 'nulls estado', count(*) FILTER (WHERE estado IS NULL) FROM t
    UNION ALL SELECT 'rows', count(*) FROM t"""
)
def dup_and_null_counts(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_partkey", "l_suppkey", "nullif(l_returnflag, 'A') as flag", "nullif(l_linestatus, 'O') as estado"
    )
    return profile.duplicate_and_null_counts(rows, ["l_partkey", "l_suppkey"], ["flag", "estado"])


def _codebook_sql(source: str, columns: dict[str, tuple[str, str, bool]], key: str, five: bool = False) -> str:
    """Per-column SELECTs: name -> (expression, type name, numeric)."""
    parts = []
    for name, (expression, kind, numeric) in columns.items():
        lo, hi = (f"min({name})::DOUBLE", f"max({name})::DOUBLE") if numeric else ("NULL::DOUBLE", "NULL::DOUBLE")
        verdict = (
            f"CASE WHEN count({name}) > count(DISTINCT {name}) THEN 'Sí (' || (count({name}) - count(DISTINCT {name}))"
            " || ' duplicados)' ELSE 'No (PK válida)' END"
            if name == key
            else f"CASE WHEN count(*) > count(DISTINCT {name}) + (CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END)"
            " THEN 'Sí' ELSE 'No' END"
        )
        values = f"list_sort(list(DISTINCT {name}::VARCHAR) FILTER (WHERE {name} IS NOT NULL))"
        adaptive = (
            f"CASE WHEN count(DISTINCT {name}) > 50 THEN '(' || count(DISTINCT {name}) || ' valores) Ej: '"
            f" || array_to_string({values}[1:5], ', ') ELSE coalesce(array_to_string({values}, ', '), '') END"
        )
        few = f"coalesce(array_to_string({values}[1:5], ', '), '')"
        parts.append(
            f"""SELECT '{name}' AS variable, '{kind}' AS type, count(*) - count({name}) AS nulls,
            round((count(*) - count({name})) * 100.0 / count(*), 2)::DOUBLE AS null_percent,
            count(DISTINCT {name}) AS distinct_values, {lo} AS minimum, {hi} AS maximum, {verdict} AS duplicates,
            {few if five else adaptive} AS sample
            FROM (SELECT {expression} AS {name} FROM {source})"""
        )
    return " UNION ALL ".join(parts)


@query(
    _codebook_sql(
        "customer",
        {
            "c_custkey": ("c_custkey", "bigint", True),
            "c_name": ("c_name", "string", False),
            "c_nationkey": ("c_nationkey", "int", True),
            "c_acctbal": ("c_acctbal", "double", True),
            "c_mktsegment": ("nullif(c_mktsegment, 'BUILDING')", "string", False),
        },
        "c_custkey",
    )
)
def codebook_numeric(spark, sf):
    df = table(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return profile.codebook(df, key="c_custkey", digits=2)


@query(
    _codebook_sql(
        "orders",
        {
            "o_custkey": ("o_custkey", "bigint", True),
            "o_orderstatus": ("o_orderstatus", "string", False),
            "o_orderdate": ("cast(o_orderdate as date)", "date", False),
            "o_orderpriority": ("nullif(o_orderpriority, '5-LOW')", "string", False),
        },
        "o_custkey",
    )
)
def codebook_repeated_key(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_custkey",
        "o_orderstatus",
        "cast(o_orderdate as date) as o_orderdate",
        "nullif(o_orderpriority, '5-LOW') as o_orderpriority",
    )
    return profile.codebook(df, key="o_custkey", digits=2)


_CUSTOMER = {
    "c_custkey": ("c_custkey", "bigint", True),
    "c_nationkey": ("c_nationkey", "int", True),
    "c_acctbal": ("c_acctbal", "double", True),
    "c_mktsegment": ("nullif(c_mktsegment, 'BUILDING')", "string", False),
}


def _customers(spark, sf):
    df = table(spark, sf, "customer").select(*_CUSTOMER)
    return df.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))


@query(f"SELECT * EXCLUDE (minimum, maximum) FROM ({_codebook_sql('customer', _CUSTOMER, 'c_custkey', five=True)})")
def codebook_five(spark, sf):
    """Codebook with five sample values and without ranges."""
    return profile.codebook(_customers(spark, sf), key="c_custkey", digits=2, min_max=False, sample="five")


@query(f"SELECT * EXCLUDE (minimum, maximum, duplicates, sample) FROM ({_codebook_sql('customer', _CUSTOMER, '')})")
def codebook_simple(spark, sf):
    """Types, nulls and distinct values only."""
    return profile.codebook(_customers(spark, sf), digits=2, min_max=False, duplicates=False, sample=None)


@query(
    f"""SELECT * EXCLUDE (distinct_values, duplicates, sample), distinct_values AS exact_distinct, true AS distinct_near,
      CASE WHEN minimum IS NOT NULL THEN true END AS median_near FROM ({_codebook_sql('customer', _CUSTOMER, '')})"""
)
def profile_merged(spark, sf):
    """A codebook united from stored profiles of four parts; estimates are checked against the whole table."""
    df = _customers(spark, sf)
    parts = [stage(profiles.file_profile(df.filter(F.col("c_custkey") % 4 == i), f"part {i}"), "profile") for i in range(4)]
    found = profiles.merged_codebook(parts, digits=2)
    numbers = [c for c, (_, _, numeric) in _CUSTOMER.items() if numeric]
    exact = df.agg(
        *[F.count_distinct(c).alias(c) for c in _CUSTOMER],
        *[F.percentile(c, F.array(F.lit(0.44), F.lit(0.56))).alias(f"{c}_mid") for c in numbers],
    )
    lines = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(c).alias("exact_distinct"),
            (F.col(f"{c}_mid") if c in numbers else F.lit(None).cast("array<double>")).alias("_mid"),
        )
        for c in _CUSTOMER
    ]
    both = found.join(exact.select(F.inline(F.array(*lines))), "variable")
    near = F.abs(F.col("distinct_values") - F.col("exact_distinct")) <= 0.08 * F.col("exact_distinct")
    return both.select(
        *[c for c in found.columns if c not in ("distinct_values", *profiles.QUANTILES)],
        "exact_distinct",
        near.alias("distinct_near"),
        F.when(F.col("minimum").isNotNull(), F.col("median").between(F.col("_mid")[0], F.col("_mid")[1])).alias("median_near"),
    )


# --- joins -------------------------------------------------------------------------------


@query(
    """WITH a AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k, o_orderpriority AS p, o_totalprice
      FROM orders), b AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k,
      o_orderpriority AS p FROM orders)
    SELECT a.k, a.p, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM a JOIN b
      ON a.k IS NOT DISTINCT FROM b.k AND a.p IS NOT DISTINCT FROM b.p GROUP BY a.k, a.p"""
)
def join_null_safe(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "case when o_orderstatus = 'P' then null else o_orderkey end as k", "o_orderpriority as p", "o_totalprice"
    )
    out = joins.join_null_safe(rows, rows.select("k", "p").distinct(), ["k", "p"])
    return out.groupBy("k", "p").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, "AREA_EVALUACION", "COMPETENCIA", n_name AS texto FROM (
      SELECT l_orderkey, l_linenumber, l_quantity, 'AREA ' || (l_suppkey % 5) AS "AREA_EVALUACION",
        'C' || l_linenumber AS "COMPETENCIA" FROM lineitem)
    LEFT JOIN (SELECT 'AREA ' || (n_nationkey % 5) AS a, 'C' || (n_nationkey // 5 + 1) AS c, n_name FROM nation)
      ON "AREA_EVALUACION" = a AND "COMPETENCIA" = c"""
)
def left_equiv(spark, sf):
    grades = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "concat('AREA ', l_suppkey % 5) as AREA_EVALUACION",
        "concat('C', l_linenumber) as COMPETENCIA",
    )
    texts = table(spark, sf, "nation").selectExpr(
        "concat('AREA ', n_nationkey % 5) as AREA_EVALUACION",
        "concat('C ', cast(n_nationkey div 5 + 1 as string)) as COMPETENCIA",
        "concat(n_name, ' ') as texto",
    ).withColumn("COMPETENCIA", F.translate("COMPETENCIA", " ", ""))
    return joins.with_equivalence(grades, texts, ["AREA_EVALUACION", "COMPETENCIA"])


_LOOKUP = """SELECT s_nationkey, count(*) AS n, round(sum(l_quantity), 2) AS horas FROM lineitem
  LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey"""


def _lookup(spark, sf, **limits):
    lines = table(spark, sf, "lineitem").selectExpr("l_suppkey as s_suppkey", "l_orderkey", "l_quantity")
    sites = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    out = joins.join_lookup(lines, sites, ["s_suppkey"], "left", **limits)
    return out.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("horas")
    )


@query(_LOOKUP)
def lookup_join(spark, sf):
    return _lookup(spark, sf)


@query(_LOOKUP)
def lookup_join_salted(spark, sf):
    """The same lookup beyond the broadcast bound: both sides shuffled with a salt."""
    return _lookup(spark, sf, rows=0)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, sede, grado,
      CASE WHEN sede IS NOT NULL THEN sum(l_quantity) OVER (PARTITION BY sede, grado) END AS total
    FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_suppkey % 9 END AS sede, l_returnflag AS grado FROM lineitem)"""
)
def site_hours_joined_back(spark, sf):
    hours = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "case when l_linestatus = 'O' then null else l_suppkey % 9 end as sede",
        "l_returnflag as grado",
    )
    return joins.group_total_back(hours, ["sede", "grado"], "l_quantity", "total")


_SITES = "CASE l_suppkey % 4 WHEN 0 THEN '01 PACHACUTEC' WHEN 1 THEN '05 CUSCO' WHEN 2 THEN '08 VMT PARAISO' END"


@query(
    f"""SELECT *, CASE WHEN sede IS NOT NULL THEN 8 END AS semanas_prom_bimestre,
      total_horas_semanales * 8 AS total_horas_bimestre,
      CASE WHEN sede = '01 PACHACUTEC' THEN 4.0::DOUBLE WHEN sede IS NOT NULL THEN 4.5::DOUBLE END AS bimestres_anio,
      CASE WHEN sede IS NOT NULL THEN 0 END AS extra_horas_anio,
      total_horas_semanales * 8 * CASE WHEN sede = '01 PACHACUTEC' THEN 4.0::DOUBLE ELSE 4.5::DOUBLE END AS total_horas_anio,
      2025 AS "ANIO"
    FROM (SELECT sede, area, ciclo, horas_semanales, grado_detalle,
      CASE WHEN sede IS NOT NULL THEN sum(horas_semanales) OVER (PARTITION BY sede, grado_detalle) END AS total_horas_semanales
      FROM (SELECT {_SITES} AS sede, l_returnflag AS area, l_linestatus AS ciclo, l_quantity AS horas_semanales,
        'GRADO ' || l_linenumber AS grado_detalle FROM lineitem))"""
)
def yearly_hours(spark, sf):
    hours = table(spark, sf, "lineitem").selectExpr(
        f"{_SITES} as sede",
        "l_returnflag as area",
        "l_linestatus as ciclo",
        "l_quantity as horas_semanales",
        "concat('GRADO ', l_linenumber) as grado_detalle",
    )
    return with_yearly_hours(hours, 2025)


# --- reshape -----------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, medida, valor FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS medida, l_quantity AS valor FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount', nullif(l_discount, 0) FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem)"""
)
def unpivot_wide(spark, sf):
    wide = table(spark, sf, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    return reshape.unpivot_columns(
        wide, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"], "medida", "valor"
    )


_WIDE = """SELECT l_suppkey AS dni, max(l_quantity) AS s1, max(l_tax) AS s2, max(l_returnflag) AS n1, min(l_linestatus) AS n2
  FROM lineitem GROUP BY l_suppkey"""
_PAIRS = f"""WITH w AS ({_WIDE}) SELECT dni, 'C1' AS codigo, s1 AS valor, n1 AS nivel FROM w
  UNION ALL SELECT dni, 'C2', s2, n2 FROM w"""


def _wide(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("dni")).agg(
        F.max("l_quantity").alias("s1"),
        F.max("l_tax").alias("s2"),
        F.max("l_returnflag").alias("n1"),
        F.min("l_linestatus").alias("n2"),
    )


@query(_PAIRS)
def double_unpivot_join(spark, sf):
    return reshape.unpivot_join(
        _wide(spark, sf), ["dni"], {"s1": "C1", "s2": "C2"}, {"n1": "C1", "n2": "C2"}, "codigo", "valor", "nivel"
    )


@query(_PAIRS)
def double_unpivot_rows(spark, sf):
    """The same rows without a join, for unique ids."""
    return reshape.unpivot_pairs(
        _wide(spark, sf), ["dni"], {"C1": ("s1", "n1"), "C2": ("s2", "n2")}, "codigo", "valor", "nivel"
    )


@query(
    """SELECT c_custkey, 'LB' AS escenario, c_mktsegment AS nivel FROM customer
    UNION ALL SELECT c_custkey, 'LS', c_name FROM customer"""
)
def unpivot_levels(spark, sf):
    return reshape.unpivot_labelled(
        table(spark, sf, "customer"), ["c_custkey"], {"c_mktsegment": "LB", "c_name": "LS"}, "escenario", "nivel"
    )


@query(
    """SELECT c_custkey, cast(fecha AS date) AS fecha, asistencia, c_name AS "ASISTENCIAS ESPERADAS" FROM (
      SELECT c_custkey, '2025-03-04' AS fecha, cast(c_nationkey AS string) AS asistencia, c_name FROM customer
      UNION ALL SELECT c_custkey, '2025-03-05', c_mktsegment, c_name FROM customer
      UNION ALL SELECT c_custkey, '2023-03-15', NULL, c_name FROM customer)"""
)
def unpivot_dates(spark, sf):
    wide = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "c_nationkey as `2025-03-04`",
        "c_mktsegment as `5/3/2025`",
        "cast(null as string) as `45000`",
        "c_name as total",
    )
    return reshape.unpivot_dates(wide, ["c_custkey"], ["2025-03-04", "5/3/2025", "45000"])


@query(
    """SELECT p_partkey, grado, unnest(CASE grado WHEN '1ER Y 2DO GRADO' THEN ['1ER GRADO', '2DO GRADO']
      WHEN '3ER Y 4TO GRADO' THEN ['3ER GRADO', '4TO GRADO'] ELSE [grado] END) AS grado_detalle
    FROM (SELECT p_partkey, CASE WHEN p_size < 20 THEN '1ER Y 2DO GRADO' WHEN p_size < 40 THEN '3ER Y 4TO GRADO'
      ELSE p_type END AS grado FROM part)"""
)
def explode_pairs(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "case when p_size < 20 then '1ER Y 2DO GRADO' when p_size < 40 then '3ER Y 4TO GRADO' else p_type end as grado",
    )
    return reshape.expand_values(
        rows,
        "grado",
        {"1ER Y 2DO GRADO": ("1ER GRADO", "2DO GRADO"), "3ER Y 4TO GRADO": ("3ER GRADO", "4TO GRADO")},
        "grado_detalle",
    )


@query(
    """SELECT c_custkey, unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN ['01', '02', '03'] ELSE [c_mktsegment] END) AS sede
    FROM customer"""
)
def replicate_site(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_custkey", "c_mktsegment as sede")
    return reshape.replicate_value(rows, "sede", "BUILDING", ["01", "02", "03"])


@query(
    """SELECT o_custkey, o_orderkey, first_value(v IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS etiqueta
    FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS v FROM orders)"""
)
def backfill_label(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_custkey", "o_orderkey", "case when o_orderstatus = 'F' then o_orderpriority end as v"
    )
    return reshape.backfill(rows, ["o_custkey"], "o_orderkey", "v", "etiqueta", block=1000).drop("v")


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'LOGRADO' WHEN 'O' THEN NULL ELSE 'INICIO' END AS respuesta,
      'p1' AS pregunta FROM orders"""
)
def chosen_question(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'F' then 'LOGRADO' when 'O' then null else 'INICIO' end as q1",
        "o_orderpriority as q2",
    )
    return reshape.chosen_question(rows, ["o_orderkey"], {"q1": "p1", "q2": "p2"}, "p1")


# --- set operations and schema -----------------------------------------------------------


@query(
    """SELECT c_custkey AS id, c_name AS nombre, c_nationkey AS sede, c_acctbal AS saldo, c_mktsegment AS segmento,
      '2025' AS "ANIO_FUENTE" FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, '2026' FROM supplier"""
)
def union_aligned(spark, sf):
    first = table(spark, sf, "customer").toDF("id", "nombre", "sede", "saldo", "segmento")
    second = table(spark, sf, "supplier").selectExpr(
        "s_acctbal as saldo", "s_suppkey as id", "s_nationkey as sede", "s_name as nombre"
    )
    return combine.union_years({"2025": first, "2026": second})


@query(
    """SELECT c_custkey AS "DNI", NULL::VARCHAR AS "TUTOR", c_mktsegment AS "GRADO",
      try_cast(c_mktsegment AS DOUBLE) AS "A_REALES", c_acctbal AS "A_ESPERADAS" FROM customer"""
)
def project_layout(spark, sf):
    return schema.project(
        table(spark, sf, "customer").withColumn("texto", F.col("c_mktsegment")),
        {"c_custkey": "DNI", "tutor": "TUTOR", "c_mktsegment": "GRADO", "texto": "A_REALES", "c_acctbal": "A_ESPERADAS"},
        {"A_REALES": "double"},
    )


@query(
    """SELECT p_partkey AS "ID__c", coalesce(nullif(p_type, 'ECONOMY'), p_name) AS "TEMAS__c", p_brand AS "AREA__c"
    FROM part"""
)
def synonyms_and_suffix(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey as ID", "nullif(p_type, 'ECONOMY') as TEMA", "p_brand as AREAS", "p_name as TEMAS"
    )
    merged = schema.rename_synonyms(rows, {"TEMAS__c": ("TEMA", "TEMAS"), "AREA__c": ("AREA", "AREAS")})
    return schema.add_suffix(merged)


@query("SELECT n_name, n_regionkey, 'n_nationkey' AS descartadas FROM nation")
def keep_known_fields(spark, sf):
    kept, unknown = schema.keep_known(table(spark, sf, "nation"), ["n_name", "n_regionkey", "otro"])
    return kept.withColumn("descartadas", F.lit(" ".join(unknown)))


# --- load results ------------------------------------------------------------------------

_RESULTS = """SELECT event_type <> 'error' AND event_type <> 'click' AS success,
  CASE WHEN event_type = 'error' THEN 'campo ' || (event_id % 17) END AS errors FROM events"""


def _results(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_type <> 'error' and event_type <> 'click' as success",
        "case when event_type = 'error' then concat('campo ', event_id % 17) end as errors",
    )


@query(
    f"""SELECT count(*) FILTER (WHERE success) AS inserted, count(*) FILTER (WHERE NOT success) AS failed,
    count(*) AS total FROM ({_RESULTS})"""
)
def load_counts(spark, sf):
    return load_summary(_results(spark, sf))


@query(
    f"""SELECT coalesce(errors, 'Sin detalle') AS error, count(*) AS n FROM ({_RESULTS}) WHERE NOT success
    GROUP BY 1 ORDER BY n DESC, error LIMIT 10"""
)
def load_top_errors(spark, sf):
    return top_errors(_results(spark, sf))
