"""Connected components of links, by contraction in Spark."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.stored import stored


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame | None:
    """(node, root): the smallest node of its component for every node with a link; None without links.

    Each step hangs every root below the neighbour with the least hash, jumps over one generation,
    and contracts the links; what stays is written. Hashes change with the step, so that no order
    of the nodes, such as a chain in the order of its numbers, takes more than a logarithm of steps
    (expected). Rows of a node are never gathered: the least neighbour is a partial aggregate.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    for step in count():
        if links.isEmpty():
            break
        own, other = (F.struct(F.xxhash64(c, F.lit(step)).alias("h"), F.col(c).alias("k")) for c in ("a", "b"))
        parent = both_ways(links).groupBy("a").agg(F.min(other).alias("least"))
        parent = stored(parent.select(F.col("a").alias("node"), F.least(own, "least")["k"].alias("root")), "parents")
        above = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        parent = stored(parent.join(above, "root").select("node", F.col("_up").alias("root")), "jumped")
        if roots is None:
            roots = parent
        else:
            new = parent.select(F.col("node").alias("root"), F.col("root").alias("_new"))
            roots = stored(roots.join(new, "root", "left").select("node", F.coalesce("_new", "root").alias("root")), "roots")
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        moved = links.join(a, "a").join(b, "b").where("_a <> _b")
        links = stored(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
    if roots is None:
        return None
    least = roots.groupBy("root").agg(F.min("node").alias("_least"))
    return stored(roots.join(least, "root").select("node", F.col("_least").alias("root")), "least")
