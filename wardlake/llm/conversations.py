"""Chat formatting: logged snapshots of a conversation collapse into its longest state.

Turns of a conversation are ordered by turn, role and text; rows that repeat all four columns are
one turn. Each turn gets a hash of its place, role and text (two of 64 bits), and the rolling xor
of these names the prefix that ends there. A conversation whose whole is a proper prefix of another
is dropped by an anti-join on prefixes, of conversations with equal turns the smallest id stays,
and only then the rest is rendered, in parts of ``PART`` turns.

No step gathers a conversation: places and rolling hashes are found within chunks of turns and
offset by the totals of earlier chunks, so a conversation that holds a third of all rows is worked
on in many tasks. Equal prefixes are aggregated before the join, so that a common first turn or a
conversation logged a million times meets itself once.

Defined results: null roles and texts are values of their own, rendered empty; a null id is a
conversation; conversations without rows do not exist; other columns are dropped; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.stored import stored

PART = 512
OPENING, CLOSING = "<|im_start|>", "<|im_end|>\n"


def _nth(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, turn, role, text, place): distinct turns with their places from 1."""
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    rows = rows.withColumn("key", F.sha2(F.to_json(F.struct("role", "text")), 256))
    rows = rows.dropDuplicates(["conv_id", "turn", "key"]).drop("key")
    rows = rows.withColumn("chunk", F.floor(F.coalesce("turn", F.lit(-(2**40))) / PART))
    rows = stored(rows, "turns")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("conv_id", "chunk").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    placed = rows.withColumn("_at", F.row_number().over(order))
    joined = placed.join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
    return joined.select("conv_id", "chunk", "turn", "role", "text", (F.col("_at") + F.col("offset")).alias("place"))


def prefixes(placed: DataFrame) -> DataFrame:
    """(conv_id, place, p1, p2, is_last): the rolling hash after each turn."""
    filled = [F.col("place"), F.col("role").isNull(), _nth("role"), F.col("text").isNull(), _nth("text")]
    rows = placed.select("conv_id", "chunk", "place", *(F.xxhash64(F.lit(seed), *filled).alias(f"h{seed}") for seed in (1, 2)))
    rows = stored(rows, "hashes")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"), F.max("place").alias("end"))
    totals = totals.select(
        F.col("conv_id").alias("_conv"),
        F.col("chunk").alias("_chunk"),
        F.coalesce(F.bit_xor("t1").over(before), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("t2").over(before), F.lit(0)).alias("b2"),
        F.max("end").over(Window.partitionBy("conv_id")).alias("turns"),
    )
    within = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = rows.withColumn("r1", F.bit_xor("h1").over(within)).withColumn("r2", F.bit_xor("h2").over(within))
    joined = rolled.join(totals, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
    return joined.select(
        "conv_id",
        "place",
        F.col("r1").bitwiseXOR(F.col("b1")).alias("p1"),
        F.col("r2").bitwiseXOR(F.col("b2")).alias("p2"),
        (F.col("place") == F.col("turns")).alias("is_last"),
    )


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of conversations that prefix no longer one, one of equal ones."""
    key = ["place", "p1", "p2"]
    wholes = hashes.where("is_last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = hashes.where("not is_last").select(*key).distinct()
    return wholes.join(inner, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPENING), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSING))


def collapsed(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, rendered): what stays of (conv_id, turn, role, text)."""
    placed = stored(numbered(turns), "placed")
    kept = maximal(stored(prefixes(placed), "prefixes"))
    kept = kept.select(F.col("conv_id").alias("_kept"), "n_turns", "n_copies")
    rows = placed.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")))
    part = F.floor((F.col("place") - 1) / PART)
    lines = F.sort_array(F.collect_list(F.struct("place", render(F.col("role"), F.col("text")).alias("line"))))
    return (
        rows.groupBy("conv_id", part.alias("part"), "n_turns", "n_copies")
        .agg(lines.alias("lines"))
        .select("conv_id", "part", "n_turns", "n_copies", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"))
    )
