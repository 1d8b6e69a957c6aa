"""Keys, star, marts and checks on small frames, against plain counting."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardlake.operators import keys, quality
from wardlake.plans import marts, star
from wardlake.plans.admissions import admissions_silver, admissions_staging

HEADER = "data_internacao string, especialidade_hospitalar string, municipio_residencia string, codigo_municipio_ibge string, idade string, sexo_paciente string, numero_internacoes string"
ROWS = [
    ("2024-01-01", "UTI", "Natal", "2408102", "70", "M", "2"),
    ("2024-01-01", "UTI", "Natal", "0000000", "70", "M", "1"),
    ("2024-07-02", "PEDIATRIA", "Caicó", "2402006", "5", "F", "1"),
    ("2025-10-02", "Urologia", "Caicó", None, None, "F", "3"),
    ("2025-10-02", "Urologia", "Natal", "2408102", "-1", "M", "1"),
    ("2025-10-02", "Urologia", None, None, None, None, None),
]


@pytest.fixture(scope="module")
def staging(spark):
    return admissions_staging(admissions_silver(spark.createDataFrame(ROWS, HEADER)))


@pytest.fixture(scope="module")
def built(staging):
    return star.build_star(staging)


def test_conflicting_codes_are_reported_and_resolved(staging, built):
    conflicts = quality.conflicting_attributes(staging, "municipio_residencia", "codigo_municipio_ibge")
    assert {(r.municipio_residencia, r.n_values) for r in conflicts.collect()} == {("Natal", 2), ("Caicó", 2)}
    codes = {r.municipio_residencia: r.codigo_municipio_ibge for r in built.municipality.collect()}
    assert codes == {"Natal": "2408102", "Caicó": "2402006", "Não informado": "0000000"}


def test_fact_loses_and_doubles_nothing(staging, built):
    row = quality.reconcile(staging, "numero_internacoes", built.fact, "qtd_internacoes").first()
    assert (row.detail_total, row.summary_total, row.difference) == (9, 9, 0)
    assert tuple(quality.reconcile_total(built.admissions, built.fact, "qtd_internacoes").first()) == (9, 9, 0)
    assert quality.repeated_keys(built.fact, star.FACT_KEYS).count() == 0


def test_dimension_keys_are_dense_in_order(built):
    dims = [
        (built.time, "id_tempo", ["data_internacao"]),
        (built.specialty, "id_especialidade", ["especialidade_padrao"]),
        (built.patient, "id_paciente", ["faixa_etaria", "sexo", "idade"]),
        (built.municipality, "id_municipio", ["municipio_residencia"]),
    ]
    for df, key, order in dims:
        rows = df.orderBy(key).collect()
        assert [r[key] for r in rows] == list(range(1, len(rows) + 1))
        naturals = [tuple(r[c] for c in order) for r in rows]
        assert naturals == sorted(naturals)
    assert [df.count() for df, *_ in dims] == [3, 3, 5, 3]


def test_time_attributes(built):
    row = built.time.filter("id_tempo = 2").first()
    assert row.asDict() == {
        "id_tempo": 2, "data_internacao": datetime.date(2024, 7, 2), "ano": 2024, "mes": 7, "ano_mes": "2024-07",
        "trimestre": 3, "nome_mes": "Julho", "estacao_br": "Inverno",
    }


def test_marts(built):
    assert [tuple(r) for r in marts.top_specialties(built).collect()] == [
        ("Urologia", "Outros", 5, 1), ("UTI", "Terapia Intensiva", 3, 2), ("Pediatria", "Pediatria", 1, 3),
    ]
    assert [tuple(r) for r in marts.patient_profile(built).collect()] == [
        ("60+", "Masculino", 3, 33.33), ("Não informado", "Feminino", 3, 33.33), ("0-17", "Feminino", 1, 11.11),
        ("0-17", "Masculino", 1, 11.11), ("Não informado", "Não informado", 1, 11.11),
    ]
    assert [(r.municipio_residencia, r.uf, r.total_internacoes) for r in marts.municipality_totals(built).collect()] == [
        ("Caicó", "RN", 4), ("Natal", "RN", 4), ("Não informado", "RN", 1),
    ]
    assert [(r.ano_mes, r.total_internacoes) for r in marts.monthly_seasonality(built).collect()] == [
        ("2024-01", 3), ("2024-07", 1), ("2025-10", 5),
    ]
    assert [tuple(r) for r in marts.season_totals(built).collect()] == [("Primavera", 5), ("Verão", 3), ("Inverno", 1)]


def test_slicers(built):
    sliced = marts.sliced(built, years=[2024], flag="Capital")
    assert [tuple(r) for r in marts.patient_profile(built, sliced).collect()] == [("60+", "Masculino", 3, 100.0)]
    assert marts.patient_profile(built, marts.sliced(built, years=[1999])).count() == 0


COMMENTS = "comment_id string, data_comentario date, autor string, curtidas int, sentimento string, texto_limpo string, score_sentimento decimal(6,3)"


@pytest.fixture(scope="module")
def comments(spark):
    day = datetime.date
    rows = [
        ("a", day(2024, 1, 1), "x", 1, "positivo", "t" * 300, 0.5), ("b", None, "x", 2, "positivo", "um", 0.25),
        ("c", day(2024, 1, 2), "y", 3, "neutro", "dois", 0.0), ("d", day(2024, 1, 2), "y", 9, "neutro", "tres", 0.1),
        ("e", day(2024, 1, 2), "z", 9, "neutro", "quatro", -0.1),
    ]
    return spark.createDataFrame(rows, COMMENTS.replace("decimal(6,3)", "double")).withColumn(
        "score_sentimento", F.col("score_sentimento").cast("decimal(6,3)")
    )


def test_comment_marts(comments):
    assert [r.comment_id for r in marts.comment_sample(comments).collect()] == ["b", "d", "e", "c", "a"]
    assert [r.comment_id for r in marts.comment_sample(comments, "positivo").collect()] == ["b", "a"]
    assert len(marts.comment_sample(comments).filter("comment_id = 'a'").first().texto_resumo) == 200
    assert [tuple(r) for r in marts.sentiment_distribution(comments).collect()] == [
        ("neutro", 3, 60.0, 0.0), ("positivo", 2, 40.0, 0.375),
    ]


def test_decision_summary(built, comments):
    rows = marts.decision_summary(built, comments).collect()
    assert [tuple(r) for r in rows] == [(9, "Urologia", "Caicó", "neutro", 40.0, None)]


def test_dense_id_is_row_number(spark):
    df = spark.range(0, 20000, 1, 7).select(F.hash("id").cast("string").alias("k"), "id")
    got = keys.dense_id(df, [F.asc("k"), F.asc("id")], "n")
    want = df.withColumn("w", F.row_number().over(Window.orderBy("k", "id")))
    assert got.join(want, "id").filter("n <> w").count() == 0
    assert got.count() == 20000


def test_ranks_share_places(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.floor(F.sqrt("id")).alias("m"))
    got = keys.rank_descending(df, "m", ["k"], "r")
    want = df.withColumn("w", F.rank().over(Window.orderBy(F.desc("m"))))
    assert got.columns == ["k", "m", "r"]
    assert got.join(want, "k").filter("r <> w").count() == 0


@pytest.mark.parametrize("rows", [3, 5000])
def test_numbering_is_the_same_for_any_size(spark, rows):
    """No row passes through an exchange to one partition."""
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") % 7).alias("m"))
    for numbered in (keys.dense_id(df, [F.asc("k")], "n"), keys.rank_descending(df, "m", ["k"], "r")):
        text = numbered._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in text and "Window" not in text


def test_a_specialty_with_two_groups_doubles_nothing(spark):
    rows = [*ROWS, ("2024-03-01", "UTI", "Natal", "2408102", "70", "M", "4")]
    staged = admissions_staging(admissions_silver(spark.createDataFrame(rows, HEADER))).withColumn(
        "grupo_especialidade", F.when(F.col("mes") == 3, "Outro").otherwise(F.col("grupo_especialidade"))
    )
    two = star.build_star(staged)
    assert two.admissions == 13 and two.fact.agg(F.sum("qtd_internacoes")).first()[0] == 13
    assert two.specialty.filter("especialidade_padrao = 'UTI'").count() == 1
    conflicts = quality.conflicting_attributes(staged, "especialidade_padrao", "grupo_especialidade").collect()
    assert [tuple(r) for r in conflicts] == [("UTI", 2, "Outro", "Terapia Intensiva")]


def test_null_against_a_value_is_a_conflict(spark):
    df = spark.createDataFrame([("m", None), ("m", "1"), ("n", None), ("o", "2")], "k string, v string")
    assert [tuple(r) for r in quality.conflicting_attributes(df, "k", "v").collect()] == [("m", 2, "1", "1")]


def test_repeated_comment_ids_are_numbered_row_by_row(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), (None, "n")], "comment_id string, t string")
    rows = star.fact_comments(df).collect()
    assert sorted(r.id_comentario for r in rows) == [1, 2, 3, 4]
    assert {r.t: r.id_comentario for r in rows}["z"] == 3 and {r.t: r.id_comentario for r in rows}["n"] == 4


def test_fact_comments_numbers_in_id_order(comments):
    numbered = star.fact_comments(comments).collect()
    assert sorted((r.id_comentario, r.comment_id) for r in numbered) == [(i + 1, c) for i, c in enumerate("abcde")]


def test_null_counts_and_layer_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {(r.column_name, r.n_null) for r in quality.null_counts(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}
    assert {(r.layer, r.n_rows) for r in quality.layer_counts({"x": df, "y": df.filter("a = 1")}).collect()} == {("x", 3), ("y", 1)}
