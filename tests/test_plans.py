"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from wardlake.plans import marts, star
from wardlake.sources.storage import publish
from workload import adapters as a
from workload.queries import QUERIES


def plan(df) -> str:
    df.collect()  # the final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimensions_are_broadcast_large_ones_are_not(spark, sf_dir):
    built = star.build_star(a.staged_admissions(spark, sf_dir))
    assert plan(built.fact).count("BroadcastHashJoin") >= 4
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(built.fact.filter("qtd_internacoes > 0")).splitlines()
        # Only the offsets of the numbering stay: one row per written partition.
        assert all("[_part" in line for line in lines if "BroadcastHashJoin" in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_source_is_summed_by_hashing(spark, sf_dir):
    grain = star.admissions_grain(a.staged_admissions(spark, sf_dir))
    text = grain._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in text[text.rindex("Exchange hashpartitioning") :]


def test_comment_rows_never_meet_in_one_partition(spark, sf_dir):
    fact = star.fact_comments(a.staged_comments(spark, sf_dir))
    text = fact._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    silver = a.silver_comments(spark, sf_dir)
    assert "SinglePartition" not in silver._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_limited_before_the_shuffle(spark, sf_dir):
    text = a.silver_comments(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_texts_are_cleaned_once(spark, sf_dir):
    for df in (a.gold_comments(spark, sf_dir), marts.sentiment_distribution(a.staged_comments(spark, sf_dir))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count(".,!?]++") == 1
        assert text.count("regexp_extract_all") == 1


def test_totals_for_shares_reuse_the_groups(spark, sf_dir):
    built = star.build_star(a.staged_admissions(spark, sf_dir), store_fact=True)
    for mart in (marts.patient_profile, marts.municipality_totals):
        final = plan(mart(built))
        final = final[: final.index("Initial Plan")] + final[final.index("Subquery") :]
        assert "ReusedExchange" in final


@pytest.mark.parametrize(
    "name, pushed",
    [("q_period_filter", "GreaterThanOrEqual(l_shipdate,1996-01-01"), ("q_tfidf_given_vocabulary", "In(lang, [de,en,es,fr])")],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text
    assert pushed in text


def test_partitions_are_pruned(spark, sf_dir):
    text = QUERIES["q_partition_pruning"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ano#\d+ = 1996", text)


def test_only_needed_columns_are_read(spark, sf_dir):
    df = a.staged_admissions(spark, sf_dir).groupBy("sexo").agg(F.sum("numero_internacoes"))
    schema = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()).group(1)
    assert "l_extendedprice" not in schema and "l_returnflag" in schema


def test_published_frames_cut_the_plan(spark, sf_dir):
    stored = publish(a.staged_admissions(spark, sf_dir), "staged").frame
    assert "Join" not in stored._jdf.queryExecution().executedPlan().toString()
