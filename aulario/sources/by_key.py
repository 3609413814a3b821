"""Tables stored in buckets by a key: joins and windows on the key need no shuffle of the stored rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aulario.sources.stages import stage_folder


def write_by_key(df: DataFrame, key: str, path: str, buckets: int) -> None:
    """Replace ``path`` by the rows of ``df`` in ``buckets`` files, each sorted by ``key``.

    All rows of a key, and all without one, share a file, so reduce the table to few rows per key first.
    """
    name = _new_name()
    rows = df.repartition(buckets, f"`{key}`")
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    # Only the name goes; the files stay, as the table lies outside the warehouse.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_by_key(spark: SparkSession, key: str, path: str, buckets: int, schema: T.StructType) -> DataFrame:
    """What ``write_by_key`` wrote, in any session; Spark knows its buckets. ``buckets`` must be the number written."""
    name = _new_name()
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def stage_by_key(df: DataFrame, key: str, label: str, buckets: int | None = None) -> DataFrame:
    """Write a table by key to the shared folder and read it back; by default a bucket per shuffle partition."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{stage_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    write_by_key(df, key, path, buckets)
    return read_by_key(spark, key, path, buckets, df.schema)


def _new_name() -> str:
    return f"by_key_{uuid.uuid4().hex}"
