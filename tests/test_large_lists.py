"""Large lexicons, long stop lists, wide keys, watched layers and replaced tables."""

import random

import pytest
from pyspark.sql import functions as F

from wardlake.functions.text import lexicon_hits
from wardlake.operators import lexicon, quality
from wardlake.operators.lexicon import lexicon_counts, tokens_with_words
from wardlake.operators.terms import term_counts
from wardlake.sources import writers
from wardlake.sources.storage import publish


def test_lexicon_join_equals_trying_all_words(spark):
    rng = random.Random(8)
    word = lambda low, high: "".join(rng.choices("abcdeé", k=rng.randrange(low, high)))
    rows = [(k, [word(0, 9) for _ in range(rng.randrange(12))] if k % 9 else None) for k in range(400)]
    lexicon = sorted({word(1, 7) for _ in range(60)})
    df = spark.createDataFrame(rows, "id long, words array<string>")
    listed = spark.createDataFrame([(w,) for w in [*lexicon, lexicon[0], None]], "palavra string")
    got = {r.id: r.hits for r in lexicon_counts(df, "id", "words", listed, "hits").collect()}
    want = {r.id: r.hits for r in df.select("id", F.when(F.col("words").isNull(), 0).otherwise(lexicon_hits(F.col("words"), lexicon)).alias("hits")).collect()}
    assert got == want and len(got) == 400


def test_lexicon_of_many_words(spark):
    tokens = spark.range(20_000).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12).alias("t"))
    lexicon = spark.range(100_000).select(F.substring(F.sha2((F.col("id") + 7_000_000).cast("string"), 256), 1, 5).alias("w"))
    words = {r.w for r in lexicon.collect()}
    want = {r.t for r in tokens.collect() if any(r.t[k : k + 5] in words for k in range(8))}
    assert {r.token for r in tokens_with_words(tokens, lexicon).collect()} == want
    assert tokens_with_words(tokens, lexicon.limit(0)).count() == 0
    empty = spark.createDataFrame([("",)], "w string")
    assert tokens_with_words(tokens, empty).count() == 20_000


def test_tokens_are_listed_under_wanted_grams_only(spark, monkeypatch):
    """What is stored follows the grams that the lexicon shares with the tokens, not all grams of them."""
    rows = {}

    def seen(df, name):
        stored = publish(df, name)
        rows[name] = stored.rows
        return stored

    monkeypatch.setattr(lexicon, "publish", seen)
    tokens = spark.range(3000).select(F.concat(F.lit("palavra"), F.col("id")).alias("t"))
    few = spark.createDataFrame([("vra77",), ("xyz",)], "w string")
    assert tokens_with_words(tokens, few).count() == sum(str(k).startswith("77") for k in range(3000))
    assert rows["tokens"] == 3000 and rows["grams"] < 3 * 3000


def test_long_stop_list(spark):
    rows = [("a", "alpha beta gamma alpha"), ("b", "alpha delta"), ("a", "word77 word78x")]
    texts = spark.createDataFrame(rows, "sentimento string, texto_limpo string")
    listed = spark.range(100_000).select(F.concat(F.lit("word"), "id").alias("w")).union(spark.sql("SELECT 'alpha'"))
    got = sorted((r.sentimento, r.termo) for r in term_counts(texts, stopwords=listed).collect())
    assert got == [("a", "beta"), ("a", "gamma"), ("a", "word78x"), ("b", "delta")]


def test_wide_keys_are_counted_by_digest(spark):
    rows = [("x" * 500, 1), ("x" * 500, 1), ("x" * 500, 2), ("y", 1), (None, 3), (None, 3), (None, None)]
    df = spark.createDataFrame(rows, "_digest string, b int")
    got = sorted(map(tuple, quality.repeated_keys(df, ["_digest", "b"]).collect()), key=str)
    assert got == sorted([("x" * 500, 1, 2), (None, 3, 2)], key=str)
    many = spark.range(5000).select(F.repeat(F.col("id").cast("string"), 50).alias("t"))
    repeated = quality.repeated_keys(many.union(many.limit(3)), ["t"])
    assert repeated.count() == 3
    plan = repeated._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan  # the few digests go to the texts


def test_watched_layers_need_no_pass_of_their_own(spark, tmp_path):
    watch = quality.Watch()
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "n int, t string")
    first = watch.over(df, "raw", ["n", "t"], ["n"])
    watch.over(first.where("n IS NOT NULL"), "kept").write.parquet(str(tmp_path / "out"))
    group = "watched"
    spark.sparkContext.setJobGroup(group, group)
    report = watch.report(spark)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert sorted(map(tuple, report.collect())) == [
        ("kept", "rows", 2), ("raw", "nulls of n", 1), ("raw", "nulls of t", 2), ("raw", "rows", 3), ("raw", "sum of n", 3),
    ]


def test_readers_finish_on_the_rows_they_started_with(spark, tmp_path):
    load = lambda low, high: writers.load_table(spark.range(low, high, 1, 4).toDF("n"), "stg_versions", {"n": "bigint"}, str(tmp_path / "v"))
    try:
        load(0, 1000)
        before = spark.table("stg_versions")
        reading = before.toLocalIterator()
        seen = [next(reading).n]
        assert load(5000, 5010).count() == 10
        assert sorted(seen + [r.n for r in reading]) == list(range(1000))
        assert before.count() == 1000
        load(1, 2)
        assert len(list((tmp_path / "v").iterdir())) == 2  # the new version and the last one
        assert [r.n for r in spark.table("stg_versions").collect()] == [1]
    finally:
        spark.sql("DROP TABLE IF EXISTS stg_versions")


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    try:
        writers.load_table(spark.range(3).toDF("n"), "stg_failed", {"n": "bigint"}, str(tmp_path / "v"))
        bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no row"))).otherwise(F.col("id")).alias("n"))
        with pytest.raises(Exception, match="no row"):
            writers.load_table(bad, "stg_failed", {"n": "bigint"}, str(tmp_path / "v"))
        assert spark.table("stg_failed").count() == 3 and len(list((tmp_path / "v").iterdir())) == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS stg_failed")


def test_tables_without_a_path(spark):
    try:
        for n in (2, 5):
            assert writers.load_table(spark.range(n).toDF("n"), "stg_default", {"n": "int"}).count() == n
        assert "stg_default.versions" in writers.table_location(spark, "stg_default")
    finally:
        spark.sql("DROP TABLE IF EXISTS stg_default")
