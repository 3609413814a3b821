"""Registration helper and the stand-in facts shared by both sides of the comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry(dict):
    """Name -> (query, SQL). Used as a decorator: ``@registry.query(sql)``."""

    def query(self, sql: str | None) -> Callable:
        def register(fn: Callable[[SparkSession, str], DataFrame]):
            self[fn.__name__] = (fn, sql)
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Stand-in facts: expressions both engines read the same way.
REGULAR = {
    "DNI__c": "cast(user_id as string)",
    "FECHA__c": "cast(ts as date)",
    "ASISTENCIA__c": "case event_type when 'view' then 'A' when 'purchase' then 'A' when 'click' then 'F' when 'error' then 'FJ' end",
    "TIPO_ALUMNO__c": "case event_type when 'signup' then 'INACTIVO' when 'error' then null else 'ACTIVO' end",
    "A_REALES__c": "cast(event_id % 20 as double)",
    "A_ESPERADAS__c": "value",
    "CENTRO__c": "concat('CENTRO ', cast(user_id % 6 as string))",
}
EXTRA = {
    "DNI__c": "cast(o_custkey as string)",
    "FECHA__c": "cast(o_orderdate as date)",
    "F_INCORPORACION__c": "cast(o_orderdate as date)",
    "ASISTENCIA__c": "case o_orderstatus when 'F' then 'A' when 'O' then 'F' else 'FJ' end",
    "TIPO_ALUMNO__c": "case o_orderpriority when '5-LOW' then null when '4-NOT SPECIFIED' then 'INACTIVO' else 'ACTIVO' end",
    "A_REALES__c": "cast(o_orderkey % 100 as double)",
    "A_ESPERADAS__c": "cast(o_orderkey % 7 as double)",
    "CENTRO__c": "concat('CENTRO ', cast(o_custkey % 6 as string))",
}
GRADES = {
    "DNI__c": "cast(l_suppkey as string)",
    "REA__c": "case l_linenumber % 5 when 0 then 'Matemática' when 1 then 'Comunicación' when 2 then 'Sociemocional' when 3 then 'Tecnología' else 'Ciencia y Tecnología' end",
    "NIVEL_DE_LOGRO__c": "l_returnflag",
    "Valor_Promedio__c": "l_quantity",
    "EVALUACION__c": "case l_linestatus when 'O' then '2025-I' else '2025-II' end",
    "Competencia_texto__c": "case when l_linenumber > 5 then null else concat('C', cast(l_linenumber as string)) end",
}
SKILLS = {
    "DNI__c": "cast(o_custkey as string)",
    "Nivel_de_logro__c": "case o_orderpriority when '1-URGENT' then 'Sobresaliente' when '2-HIGH' then 'Logrado' when '3-MEDIUM' then 'En proceso' else 'En inicio' end",
    "Centro__c": "o_orderstatus",
}
SURVEY = {
    "N_de_documento__c": "cast(o_custkey as string)",
    "N_de_documento_1__c": "cast(o_custkey % 50 as string)",
    "CENTRO__c": "o_orderstatus",
    "P1": "case o_orderpriority when '1-URGENT' then 'MUY DE ACUERDO' when '2-HIGH' then 'DE ACUERDO' when '3-MEDIUM' then 'EN DESACUERDO' when '4-NOT SPECIFIED' then 'MUY EN DESACUERDO' end",
    "P2": "case o_orderpriority when '1-URGENT' then 'SIEMPRE' when '2-HIGH' then 'NUNCA' else 'DE ACUERDO' end",
}
CURRICULUM = {
    "AREA__c": "p_type",
    "TEMAS__c": "p_name",
    "CENTRO__c": "p_brand",
    "STATUS__c": "case when p_size > 25 then 'AVANZADO' else 'INICIADO' end",
    "CICLO__c": "cast(p_size % 3 as string)",
    "BIMESTRE__c": "cast(p_size % 4 as string)",
    "NIVEL__c": "case when p_retailprice > 950 then 'ALTO' else 'BASE' end",
}
SOURCES = {
    "attendance": ("events", REGULAR),
    "extra": ("orders", EXTRA),
    "grades": ("lineitem", GRADES),
    "skills": ("orders", SKILLS),
    "survey": ("orders", SURVEY),
    "curriculum": ("part", CURRICULUM),
}


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = SOURCES[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} as `{c}`" for c, e in columns.items()])


def cte(*names: str) -> str:
    """``WITH`` clause defining stand-in facts for the SQL side."""
    parts = []
    for name in names:
        source, columns = SOURCES[name]
        body = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
        parts.append(f"{name} AS (SELECT {body} FROM {source})")
    return "WITH " + ", ".join(parts) + " "
