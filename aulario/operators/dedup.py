"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _latest(df: DataFrame, key: str, first: Sequence[Column]) -> DataFrame:
    # ``row_number() = 1`` lets Spark keep one row per key on each task before the shuffle,
    # so a key that fills a third of the table arrives as one row per task.
    order = Window.partitionBy(key).orderBy(*first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per key, the latest; all null keys count as one key.

    A null timestamp sorts last and therefore wins. Equal timestamps are decided by the
    largest ``tiebreak`` values, so the result does not depend on row order.
    """
    return _latest(df, key, [F.col(ts).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tiebreak]])


def latest_keep_null_keys(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per non-null key, the latest; rows without a key are all kept.

    A null timestamp loses to any other. Rows without a key are never shuffled.
    """
    keyed = df.filter(F.col(key).isNotNull())
    latest = _latest(keyed, key, [F.col(ts).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]])
    return latest.unionByName(df.filter(F.col(key).isNull()))
