"""Dense keys and ranks over a whole frame without a single-task sort of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.sources.storage import publish

_PLACE_BITS = 33  # documented layout of monotonically_increasing_id


def dense_id(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add 1, 2, 3, ... in the given total order, for frames of any size.

    The range-sorted frame is written once with its place (partition, row in partition); the
    number of rows in the partitions before is then added. The offsets have one row per
    written partition, whatever the data: they are counted once, and go into the plan as
    values, so that readers of the result only scan and project.
    """
    spark = df.sparkSession
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    stored = publish(placed, "dense").frame.withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    counts = sorted(map(tuple, stored.groupBy("_part").agg(F.count(F.lit(1))).collect()))
    before = [0, *accumulate(rows for _, rows in counts)]
    values = ", ".join(f"({part}L, {rows}L)" for (part, _), rows in zip(counts, before)) or "(0L, 0L)"
    offsets = spark.sql(f"SELECT * FROM VALUES {values} AS t(_part, _before)")
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_part", "_place", "_before")
    )


def rank_descending(df: DataFrame, measure: str, ties: Sequence[str], name: str) -> DataFrame:
    """SQL ``RANK`` by descending measure over the whole frame; equal values share a rank.

    The rank of a value is the smallest dense id that bears it; ``ties`` makes that order
    total. No window takes the whole frame into one task.
    """
    numbered = dense_id(df, [F.desc(measure), *map(F.asc, ties)], "_id")
    ranks = numbered.groupBy(F.col(measure).alias("_measure")).agg(F.min("_id").alias(name))
    joined = numbered.join(ranks, numbered[measure].eqNullSafe(ranks["_measure"]))
    return joined.drop("_id", "_measure")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the named columns, where nulls are equal."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add the sum of the weights of a group's rows up to this one, in the given total order.

    A segmented prefix sum: the rows are range-sorted by group and order and written once; each
    written partition is summed by itself, and what its groups had in the partitions before is
    added. So a group of any size spreads over as many tasks as it has partitions, and the
    window over a group takes one row per partition, not its rows.
    """
    placed = df.orderBy(*by, *order).withColumn("_place", F.monotonically_increasing_id())
    stored = publish(placed, "sorted").frame.withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    within = Window.partitionBy("_part", *by).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("_part", *by).agg(F.sum(weight).alias("_total"))
    before = parts.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    local = stored.withColumn("_upto", F.sum(weight).over(within))
    joined = local.join(before, _same(local, before, ["_part", *by]))
    return joined.select(*[local[c] for c in df.columns], (local["_upto"] + before["_before"]).alias(name))


def rank_within(df: DataFrame, by: Sequence[str], measure: str, name: str) -> DataFrame:
    """SQL ``RANK`` by descending measure within each group; equal values share a rank, nulls last.

    Ranks are taken of the distinct measures, by a running total of their rows, and joined back on group and
    measure, so no task takes a whole group. The frame is read twice; pass a stored one.
    """
    peers = df.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(peers, by, [F.desc(measure)], F.col("_n"), "_upto")
    ranks = upto.withColumn(name, F.col("_upto") - F.col("_n") + 1)
    joined = df.join(ranks, _same(df, ranks, [*by, measure]))
    return joined.select(*[df[c] for c in df.columns], ranks[name])
