"""Deduplication that keeps a defined row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the declared order; nulls count as one key.

    ``order`` must be total within a key. Spark limits each key to its first row before the
    shuffle as well as after it, so a key with a third of all rows sends at most one row per
    input partition. ``dropDuplicates`` would keep an arbitrary row.
    """
    within = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(within)).filter("_place = 1").drop("_place")
