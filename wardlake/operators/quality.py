"""Checks a database would enforce by constraints, as frames of what violates them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.sources.storage import publish


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required column, how many rows lack it. One pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], list(required), "column_name", "n_null")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; nulls are equal.

    Keys of numbers and dates are grouped as they are. For wider ones (texts, arrays) digests are
    counted first, so that only eight bytes a row are shuffled. The rows of the repeated digests, which
    are looked up by a semi-join, are then counted by their real keys.
    """
    chosen = df.select(*key)
    if any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)) for f in chosen.schema):
        name = unused_name("_digest", key)
        hashed = chosen.withColumn(name, F.xxhash64(*key))
        repeated = hashed.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(name)
        chosen = hashed.join(publish(repeated, "repeated").frame, name, "left_semi").drop(name)
    return chosen.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def unused_name(name: str, columns: Sequence[str]) -> str:
    """A column name that none of the given ones equals, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def conflicting_attributes(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys with several values of an attribute that should depend on the key alone.

    Null is a value like any other. Reduced to distinct pairs before grouping, so a hot key
    costs no more than its number of values, and reported by count and extremes (of the
    values that are not null) rather than by a list of unknown length.
    """
    pairs = df.select(key, attribute).distinct()
    return (
        pairs.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.min(attribute).alias("lowest_value"),
            F.max(attribute).alias("highest_value"),
        )
        .filter("n_values > 1")
    )


def reconcile(detail: DataFrame, detail_measure: str, summary: DataFrame, summary_measure: str) -> DataFrame:
    """One row that compares the total of a measure before and after a join or rollup."""
    before = detail.agg(F.sum(detail_measure).alias("before"), F.lit(None).cast("long").alias("after"))
    after = summary.agg(F.lit(None).cast("long").alias("before"), F.sum(summary_measure).alias("after"))
    totals = before.unionByName(after).agg(
        F.coalesce(F.sum("before"), F.lit(0)).alias("detail_total"),
        F.coalesce(F.sum("after"), F.lit(0)).alias("summary_total"),
    )
    return totals.withColumn("difference", F.col("summary_total") - F.col("detail_total"))


def reconcile_total(total: int, summary: DataFrame, measure: str) -> DataFrame:
    """The same row where the detail's total is known, such as one observed during a write."""
    after = summary.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("summary_total"))
    detail = F.lit(total).cast("long")
    return after.select(
        detail.alias("detail_total"), "summary_total", (F.col("summary_total") - detail).alias("difference")
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named layer."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


class Watch:
    """Counts of named layers, taken while the layers are computed for some other purpose.

    ``over`` returns the frame to go on with; whoever writes it fills the counts. ``report`` needs no
    further pass over any layer.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[str]]] = {}

    def over(self, df: DataFrame, layer: str, required: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
        """Count rows, nulls of the required columns and totals of others of this layer."""
        measures = {"rows": F.count(F.lit(1))}
        measures |= {f"nulls of {c}": F.count_if(F.col(c).isNull()) for c in required}
        measures |= {f"sum of {c}": F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)) for c in sums}
        seen = Observation()
        self._seen[layer] = seen, list(measures)
        return df.observe(seen, *[m.alias(f"m{k}") for k, m in enumerate(measures.values())])

    def report(self, spark: SparkSession) -> DataFrame:
        """(layer, measure, value) of all layers, which must have been written or read whole."""
        rows = []
        for layer, (seen, names) in self._seen.items():
            values = seen.get
            rows += [(layer, name, int(values[f"m{k}"])) for k, name in enumerate(names)]
        return spark.createDataFrame(rows, "layer string, measure string, value bigint")
