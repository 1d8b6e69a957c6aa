"""Ranks, running totals and selections within groups that no single task could take."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardlake.operators import terms
from wardlake.operators.keys import rank_within, running_total


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def scored(spark, n=3000):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "a", "a", "b", None, f"c{k % 50}"]), f"t{k}", rng.choice([None, *range(40)])) for k in range(n)]
    rows += [("hot", f"u{k}", 7) for k in range(n // 2)]  # a third of all rows share one value
    return spark.createDataFrame(rows, "classe string, termo string, pontos int")


def test_rank_equals_the_window(spark, many_partitions):
    df = scored(spark)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("classe").orderBy(F.desc("pontos"))).cast("long"))
    got = rank_within(df, ["classe"], "pontos", "r")
    assert got.count() == df.count() and got.exceptAll(want).isEmpty()


def test_running_total_equals_the_window(spark, many_partitions):
    df = scored(spark)
    order = [F.desc("pontos"), F.asc("termo")]
    over = Window.partitionBy("classe").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    weight = F.length("termo")
    want = df.withColumn("s", F.sum(weight).over(over))
    got = running_total(df, ["classe"], order, weight, "s")
    assert got.count() == df.count() and got.exceptAll(want).isEmpty()
    assert running_total(df.limit(0), ["classe"], order, weight, "s").count() == 0


def test_a_large_class_is_in_many_tasks(spark, many_partitions):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("classe"), (F.col("id") * 7919 % 10_007).alias("pontos")
    )
    got = running_total(df.groupBy("classe", "pontos").agg(F.count(F.lit(1)).alias("n")), ["classe"], [F.desc("pontos")], F.col("n"), "s")
    spread = got.where("classe = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(spread) > 1
    ranked = terms.term_ranks(df.select("classe", F.lit("x").alias("termo"), "pontos"), "classe", "pontos")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # Windows take a written partition's rows of a class, or a row per written partition.
    assert all("_part" in w for w in re.findall(r"Window \[.*", plan))


@pytest.mark.parametrize("top", [1, 7, 40, 500, 1_000_000])
def test_selection_equals_sorting(spark, many_partitions, top):
    rng = random.Random(top)
    rows = [(c, f"t{rng.randrange(10**6)}-{k}", rng.choice([1, 1, 1, 2, 3, rng.randrange(90)]), k) for c in ("a", "b", "c", None) for k in range(300 if c else 40)]
    counts = spark.createDataFrame(rows, "_class string, _term string, _occurrences long, _df long")
    want = []
    for c in ("a", "b", "c", None):
        want += sorted((r for r in rows if r[0] == c), key=lambda r: (-r[2], r[1]))[:top]
    assert set(map(tuple, terms.select_most_frequent(counts, top).collect())) == set(want)
    assert terms.select_most_frequent(counts.limit(0), top).count() == 0
    plan = terms.select_most_frequent(counts, top)._jdf.queryExecution().executedPlan().toString()
    assert all("_part" in w for w in re.findall(r"Window \[.*", plan))


def test_both_ways_to_the_most_frequent_agree(spark, monkeypatch):
    rows = [("a", f"t{k}", k % 5, 1) for k in range(200)]
    counts = spark.createDataFrame(rows, "_class string, _term string, _occurrences long, _df long")
    sharded = sorted(map(tuple, terms.most_frequent(counts, 33).collect()))
    monkeypatch.setattr(terms, "SORTED_AT_ONCE", 1)
    assert sorted(map(tuple, terms.most_frequent(counts, 33).collect())) == sharded
