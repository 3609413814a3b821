"""Child-partitioned storage and state carried between runs, over the stand-in attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulario.queries.files import folder
from aulario.queries.register import Registry, cte, fact
from aulario.sources.by_key import stage_by_key
from aulario.streaming.carried import KeyState, carry, new_files

REGISTRY = Registry()
query = REGISTRY.query

CHILDREN = KeyState(
    key="DNI__c",
    least={
        "first_active": "CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN FECHA__c END",
        "first_attended": "CASE WHEN ASISTENCIA__c = 'A' THEN FECHA__c END",
    },
    most={"last_day": "FECHA__c"},
    total={"n_rows": "1"},
    latest=("FECHA__c", "CENTRO__c", "ASISTENCIA__c", "TIPO_ALUMNO__c"),
)
_FIRST_ACTIVE = "MIN(CASE WHEN TIPO_ALUMNO__c = 'ACTIVO' THEN FECHA__c END)"


def _three_runs(spark, sf, per_batch: int | None = None) -> DataFrame:
    """State after three runs over a folder that gains a third of the attendance before each."""
    rows = fact(spark, sf, "attendance").withColumn("_part", F.pmod(F.xxhash64("DNI__c", "FECHA__c", "A_ESPERADAS__c"), F.lit(3)))
    base = folder(spark, "carried")
    state = None
    for part in range(3):
        fresh = rows.filter(F.col("_part") == part).drop("_part")
        fresh.write.mode("append").parquet(f"{base}/files")
        state = carry(new_files(spark, f"{base}/files", fresh.schema, per_batch), CHILDREN, f"{base}/state", buckets=8)
    return state


@query(
    cte("attendance")
    + f"""SELECT f.DNI__c, first_active, first_attended, last_day, n_rows, l.FECHA__c, l.CENTRO__c, l.ASISTENCIA__c, l.TIPO_ALUMNO__c
    FROM (SELECT DNI__c, {_FIRST_ACTIVE} AS first_active, MIN(CASE WHEN ASISTENCIA__c = 'A' THEN FECHA__c END) AS first_attended,
            MAX(FECHA__c) AS last_day, COUNT(*) AS n_rows FROM attendance GROUP BY DNI__c) f
    JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY DNI__c ORDER BY FECHA__c DESC NULLS FIRST, CENTRO__c DESC NULLS LAST,
            ASISTENCIA__c DESC NULLS LAST, TIPO_ALUMNO__c DESC NULLS LAST) AS _n FROM attendance) l
    ON f.DNI__c IS NOT DISTINCT FROM l.DNI__c AND l._n = 1"""
)
def carried_children(spark, sf):
    """First dates, sums and latest row per child from a state that three runs have added to."""
    return _three_runs(spark, sf)


@query(
    cte("attendance")
    + f"""SELECT COUNT(*) FILTER (first_active >= date_trunc('month', (SELECT MAX(FECHA__c) FROM attendance))) AS new_active
    FROM (SELECT DNI__c, {_FIRST_ACTIVE} AS first_active FROM attendance GROUP BY DNI__c)"""
)
def carried_new_active(spark, sf):
    """Children first active in the latest month, from the carried state alone."""
    state = _three_runs(spark, sf)
    month = F.trunc(state.select(F.max("last_day").alias("m")).scalar(), "month")
    return state.agg(F.count_if(F.coalesce(F.col("first_active") >= month, F.lit(False))).alias("new_active"))


def child_days(spark, sf) -> DataFrame:
    """One row per child and day, stored by child."""
    days = fact(spark, sf, "attendance").groupBy("DNI__c", "FECHA__c").agg(F.count(F.lit(1)).alias("n_rows"))
    return stage_by_key(days, "DNI__c", "child-days")


@query(
    cte("attendance")
    + """SELECT DNI__c, FECHA__c, n_rows, ROW_NUMBER() OVER w AS day_number, date_diff('day', LAG(FECHA__c) OVER w, FECHA__c) AS gap,
    SUM(n_rows) OVER (PARTITION BY DNI__c ORDER BY FECHA__c NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT AS rows_so_far
    FROM (SELECT DNI__c, FECHA__c, COUNT(*) AS n_rows FROM attendance GROUP BY DNI__c, FECHA__c)
    WINDOW w AS (PARTITION BY DNI__c ORDER BY FECHA__c NULLS FIRST)"""
)
def child_day_gaps(spark, sf):
    """Days of each child in order, with the gap since the day before, from storage by child."""
    return day_gaps(child_days(spark, sf))


def day_gaps(days: DataFrame) -> DataFrame:
    """Number, gap in days and rows so far for each child's days."""
    w = Window.partitionBy("DNI__c").orderBy("FECHA__c")
    return days.select(
        "DNI__c",
        "FECHA__c",
        "n_rows",
        F.row_number().over(w).cast("long").alias("day_number"),
        F.datediff("FECHA__c", F.lag("FECHA__c").over(w)).cast("long").alias("gap"),
        F.sum("n_rows").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rows_so_far"),
    )
