"""Every query of the engine's operators against its SQL on the same tables; no plan leaves the
JVM or joins everything with everything. Sorted results are also compared in their order."""

import re

import pytest

import __spark_entry__ as spark_entry
from compare import connect, duck_rows, spark_rows
from workload.oracle import ORACLE
from workload.queries import QUERIES

#: The declared order of sorted results.
SORTED = {
    "q_gold_monthly": "qtd_internacoes DESC, ano_mes, especialidade_padrao, municipio_residencia, faixa_etaria, sexo, capital_interior",
    "q_patient_profile": "total_internacoes DESC, faixa_etaria, sexo",
    "q_municipality": "total_internacoes DESC, municipio_residencia",
    "q_top_specialties": "total_internacoes DESC, especialidade_padrao",
    "q_monthly_seasonality": "ano, mes",
    "q_comment_sample": "data_comentario DESC NULLS FIRST, curtidas DESC NULLS FIRST, comment_id",
    "q_sentiment_distribution": "qtd_comentarios DESC, sentimento",
    "q_term_ranks": "sentimento, score_tfidf DESC, termo",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", plan)
    got_columns, got = spark_rows(df)
    want_columns, want = duck_rows(duck, ORACLE[name])
    assert got_columns == want_columns
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(SORTED))
def test_rows_come_in_the_declared_order(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]}) ORDER BY {SORTED[name]}").fetchall()
    assert [tuple(r) for r in got.collect()] == want


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
