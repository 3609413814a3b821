"""Sinks: stage tables, CSV exports, full refresh in JSON batches, load summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.sources.versioned_load import VersionedLoad, new_version, read_results, read_target
from aulario.sources.workers import package_on_workers

__all__ = ["export_csv", "full_refresh", "load_summary", "read_results", "read_target", "top_errors", "write_stage"]

# Fixed value: records per insert batch of the target service.
RECORDS_PER_BATCH = 1000
NO_DETAIL = "Sin detalle"


def write_stage(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Hand a stage over as Parquet, partitioned by year where the year is a filter."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def export_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """UTF-8 CSV export with header; Spark writes one file per task, without a byte mark. White space at a text's ends stays."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def full_refresh(
    df: DataFrame,
    path: str,
    batch: int = RECORDS_PER_BATCH,
    rules: Mapping[str, Column] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Replace a target's records by those of ``df``, in JSON batches of at most ``batch``; the outcome of every record.

    ``rules`` maps an error text to the condition under which a record is rejected with it; rejected records
    are left out of the target and reported. The result has the columns ``batch, position, key, success, errors``, ``key``
    being the text of the named column. The target changes in one step when all tasks have ended: a load that
    fails leaves the records of the one before in force, and a repeated task leaves no record twice. Nulls
    are written out as nulls. Read the target with :func:`read_target`.
    """
    spark = df.sparkSession
    package_on_workers(spark)
    spark.dataSource.register(VersionedLoad)
    found = [F.when(wrong, F.lit(text)) for text, wrong in (rules or {}).items()]
    errors = F.array_compact(F.array(*found)) if found else F.array()
    fields = [F.col(f"`{c}`") for c in df.columns]
    (
        df.select(
            F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"),
            (F.col(f"`{key}`").cast("string") if key else F.lit(None).cast("string")).alias("key"),
            errors.cast("array<string>").alias("errors"),
        )
        .write.format("versioned_load")
        .mode("append")
        .option("path", path)
        .option("version", new_version())
        .option("batch", batch)
        .option("target_schema", df.schema.json())
        .save()
    )
    return read_results(spark, path)


def load_summary(results: DataFrame) -> DataFrame:
    """Inserted, failed and total counts of a result table (``success``, ``errors``)."""
    ok = F.lower(F.col("success").cast("string")) == "true"
    return results.agg(
        F.count_if(ok).alias("inserted"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def top_errors(results: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent error texts of failed records.

    A list of errors is read as one text, joined by `` | ``; none at all has a fixed text.
    """
    failed = ~F.coalesce(F.lower(F.col("success").cast("string")) == "true", F.lit(False))
    detail = F.col("errors")
    if dict(results.dtypes)["errors"].startswith("array"):
        detail = F.array_join(detail.cast("array<string>"), " | ")
    return (
        results.filter(failed)
        .groupBy(F.coalesce(detail, F.lit(NO_DETAIL)).alias("error"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "error")
        .limit(k)
    )
