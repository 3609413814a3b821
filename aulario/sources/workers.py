"""Python workers of a local session: they learn where this package lies."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def package_on_workers(spark: SparkSession) -> None:
    """Put the package on the path of workers that a local session starts; on a cluster it is deployed with the job."""
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return
    root = str(Path(__file__).resolve().parents[2])
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
