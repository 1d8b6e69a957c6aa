"""The whole warehouse: what it moves and keeps on disk while it is written."""

from __future__ import annotations

import datetime
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardlake.plans.admissions import admissions_silver
from wardlake.plans.warehouse import build_warehouse
from wardlake.sources import writers
from wardlake.sources.storage import FREE_SHUFFLES, passing_steps, publish, settings, shared_dir

OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def shuffles(spark) -> int:
    """The number of the next shuffle; asking for it takes one."""
    return spark.sparkContext._jsc.sc().newShuffleId()


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def admissions(spark, n=400):
    """Rows over eight tasks and four years, one of them with a single row; some without a date, names or counts."""
    k = F.col("id")
    year = F.when(k == 7, 1999).otherwise(2022 + k % 3).cast("string")
    return spark.range(0, n, 1, 8).select(
        F.when(k % 50 != 0, F.concat(year, F.lit("-0"), (k % 9 + 1).cast("string"), F.lit("-15"))).alias("Data da Internação"),
        F.when(k % 11 != 0, F.concat(F.lit("clinica "), (k % 5).cast("string"))).alias("Especialidade Hospitalar"),
        F.when(k % 13 != 0, F.concat(F.lit("Cidade "), (k % 4).cast("string"))).alias("municipio_residencia"),
        (k % 90).cast("string").alias("idade"),
        F.when(k % 3 == 0, "F").alias("sexo_paciente"),
        F.when(k % 17 != 0, (k % 4 + 1).cast("string")).alias("numero_internacoes"),
        F.lit("further").alias("_ano"),
    )


def comments(spark, n=60):
    k = F.col("id")
    return spark.range(0, n, 1, 4).select(
        (k % 50).cast("string").alias("comment_id"),
        F.lit("2024-01-01").alias("data_comentario"),
        F.lit("1").alias("curtidas"),
        F.concat(F.lit("atendimento excelente "), k.cast("string")).alias("texto_comentario"),
        k.alias("pos"),
    )


def test_silver_rows_are_dealt_out_before_columns_are_derived(spark):
    dealt = admissions_silver(admissions(spark), by_year=True)
    plain = admissions_silver(admissions(spark))
    assert dealt.columns == plain.columns
    above, _, below = dealt._jdf.queryExecution().optimizedPlan().toString().partition("RebalancePartitions")
    assert "faixa_etaria" in above and below
    assert not any(name in below for name in ("faixa_etaria", "grupo_especialidade", "capital_interior", "processed_at"))
    rows = [sorted(map(tuple, df.drop("processed_at").collect()), key=repr) for df in (dealt, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 392
    assert {r["_ano"] for r in dealt.select("_ano").collect()} == {"further"}
    only = admissions_silver(admissions(spark), years=(1999, 2022), by_year=True)
    assert sorted(r["ano"] for r in only.select("ano").distinct().collect()) == [1999, 2022]
    assert only.count() == plain.filter("ano IN (1999, 2022)").count()


def test_rows_that_lie_by_year_are_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 2000, 1, 4).withColumn("ano", (F.col("id") % 40).cast("int"))  # more than a task's open files
    first, second, copy = (str(tmp_path / name) for name in "abc")
    writers.write_parquet(df, first, partition_by="ano")
    before = shuffles(spark)
    writers.write_parquet(spark.read.parquet(first), second, partition_by="ano", dealt=True, copy_to=copy, codec="zstd")
    assert shuffles(spark) == before + 1
    for path in (first, second, copy):
        stored = spark.read.parquet(path)
        assert sorted(map(tuple, stored.select("id", "ano").collect())) == [(k, k % 40) for k in range(2000)]
    assert all(".zstd." in f for f in spark.read.parquet(second).inputFiles())
    assert spark.conf.get(OPEN) == "0"


def test_settings_are_restored_by_the_last_user(spark):
    name = next(iter(FREE_SHUFFLES))
    found = spark.conf.get(name)
    first, second = settings(spark, FREE_SHUFFLES), settings(spark, FREE_SHUFFLES)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(name) == found
    spark.conf.set(OPEN, "3")
    try:
        with pytest.raises(ZeroDivisionError), settings(spark, writers.OPEN_FILES):
            assert spark.conf.get(OPEN) == "32"
            1 / 0
        assert spark.conf.get(OPEN) == "3"
    finally:
        spark.conf.unset(OPEN)


def test_passing_steps_are_deleted_and_others_kept(spark):
    kept = publish(spark.range(5), "kept").frame
    with passing_steps(spark):
        gone = publish(spark.range(7), "gone").frame
        path = Path(gone.inputFiles()[0].removeprefix("file://")).parent
        assert path.exists() and gone.count() == 7
    assert not path.exists()
    assert kept.count() == 5


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    before = shuffle_files(spark)
    writers.write_parquet(spark.range(1000).withColumn("ano", F.col("id") % 3), str(tmp_path / "t"), partition_by="ano")
    publish(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "groups")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # they are deleted in the background
    assert not left


def test_warehouse_keeps_its_tables_and_drops_the_steps_of_texts(spark, tmp_path):
    steps = Path(shared_dir(spark).removeprefix("file://")) / "wardlake" / spark.sparkContext.applicationId
    texts = lambda: {p.name for kind in ("comments-", "bags-", "vocabulary-") for p in steps.glob(f"{kind}*")}
    before = texts()
    views = build_warehouse(
        admissions(spark), comments(spark), [F.asc("pos")], str(tmp_path / "lake"), years=(1999, 2022, 2023),
        copy_to=str(tmp_path / "copy"),
    )
    assert texts() == before
    # the single row of 1999 is in one file; so are the other years, which are small
    for table in ("silver/internacoes", "gold/fato_grao", "staging/internacoes"):
        files = [p.parent.name for p in (tmp_path / "lake" / table).glob("ano=*/*.parquet")]
        assert sorted(set(files)) == ["ano=1999", "ano=2022", "ano=2023"]
        assert files.count("ano=1999") == 1
    assert len(list((tmp_path / "lake" / "silver/internacoes").glob("ano=*/*.parquet"))) == 3
    silver = admissions_silver(admissions(spark), years=(1999, 2022, 2023))
    rows, total = silver.agg(F.count(F.lit(1)), F.sum("numero_internacoes")).first()
    for path in (tmp_path / "lake/silver/internacoes", tmp_path / "copy/silver/internacoes", tmp_path / "lake/gold/fato_grao"):
        assert spark.read.parquet(str(path)).count() == rows
    counted = {(r.layer, r.measure): r.value for r in views["camadas"].collect()}
    assert counted["bronze/internacoes", "rows"] == 400
    assert counted["silver/internacoes", "rows"] == counted["staging/internacoes", "rows"] == rows
    assert counted["staging/internacoes", "sum of numero_internacoes"] == counted["olap/fato_internacao", "sum of qtd_internacoes"] == total
    assert spark.sql("SELECT sum(total_internacoes) FROM vw_top_especialidades").first()[0] == total
    assert views["dim_tempo"].filter(F.col("data_internacao") == datetime.date(1999, 8, 15)).count() == 1
    ids = [r[0] for r in views["fato_sentimento_comentario"].select("id_comentario").collect()]
    assert sorted(ids) == list(range(1, 51))
    assert views["termos_tfidf"].count() > 0
