"""Written intermediate tables: computed once, read by several branches, kept on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_folder(spark: SparkSession) -> str:
    """The shared folder the session names for checkpoints.

    Only a local session without the setting gets a folder of its own; on a cluster the
    setting is required, since executors must reach the folder and outlive one another.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors reach")
    folder = tempfile.mkdtemp(prefix="aulario-")
    spark.conf.set(_SETTING, folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The written table cuts the lineage, survives the loss of executors, and shows Spark its
    true size when it plans a join.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
