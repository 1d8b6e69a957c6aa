"""The given tables seen as admissions and comments.

Admissions come from line items with their part and supplier (one row is one admission);
comments from documents. No table is cut: every derived value comes from a row's own
columns. Joins carry no hints; Spark picks them by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions.text import Lexicon
from wardlake.plans.admissions import admissions_silver, admissions_staging
from wardlake.plans.comments import comments_silver, comments_staging, sentiment_gold

#: The tables' texts hold none of the default words, so the queries use these.
LEXICON = Lexicon(positive=("the", "tion", "que", "der"), negative=("of", "and", "ent", "ich"))
TFIDF_STOPWORDS = (*LEXICON.words, "que", "mas", "com", "para", "uma", "muito")
#: Part types with a standard name, the others go through title case.
SPECIALTY_NAMES = {"STANDARD": "Clínica Padrão", "PROMO": "Promoção", "SMALL": "Pequena Cirurgia"}
SPECIALTY_GROUPS = {"Clínica Padrão": "Clínico", "Pequena Cirurgia": "Cirúrgico", "Economy": "Clínico"}
CAPITAL_PATTERN = "nation_1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admissions with usable values and standard column names."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.to_date("l_shipdate").alias("data_internacao"),
        F.col("p_type").alias("especialidade_hospitalar"),
        F.col("n_name").alias("municipio_residencia"),
        F.col("n_nationkey").cast("string").alias("codigo_municipio_ibge"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_size") * 2).alias("idade"),
        F.when(F.col("l_returnflag") == "A", "F")
        .when(F.col("l_returnflag") == "R", "M")
        .otherwise("NI")
        .alias("sexo_paciente"),
        F.col("l_linenumber").alias("numero_internacoes"),
    )


def raw_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same admissions as untidy text: odd headers, mixed and bad dates, padded names,
    decimal ages, bad counts, missing names and codes."""
    df = admissions(spark, sf_dir)
    line = F.col("numero_internacoes")
    date = F.col("data_internacao")
    return df.select(
        F.when(line == 2, F.date_format(date, "dd/MM/yyyy"))
        .when(line == 6, "sem data")
        .when(line != 7, date.cast("string"))
        .alias(" Data da Internação "),
        F.when(line != 5, F.concat(F.lit(" "), F.lower("especialidade_hospitalar"), F.lit("-d'Água ")))
        .alias("ESPECIALIDADE HOSPITALAR"),
        F.when(F.col("codigo_municipio_ibge") != "3", F.concat(F.lit("\t"), "municipio_residencia", F.lit(" ")))
        .alias("Município de Residência"),
        F.when(F.col("codigo_municipio_ibge") != "4", F.col("codigo_municipio_ibge")).alias("codigo_municipio_ibge"),
        F.concat(F.col("idade").cast("string"), F.lit(".75")).alias("Idade"),
        F.when(line == 1, F.lit("masculino ")).when(line == 3, " 2").otherwise(F.lower("sexo_paciente"))
        .alias("Sexo do Paciente"),
        F.when(line == 4, "x").when(line != 3, F.concat(line.cast("string"), F.lit(".9"))).alias("Número de Internações"),
        F.lit("Hospital Escola").alias("Nome  do Estabelecimento"),
    )


def silver_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admissions_silver(
        admissions(spark, sf_dir),
        names=SPECIALTY_NAMES,
        groups=SPECIALTY_GROUPS,
        capital_pattern=CAPITAL_PATTERN,
    )


def staged_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admissions_staging(silver_admissions(spark, sf_dir))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments, all columns text but the row order."""
    doc = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 365).cast("int"))
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("comment_id"),
        F.col("source").alias("post_id"),
        F.col("lang").alias("autor"),
        F.when(F.col("lang") == "es", "sem data").otherwise(day.cast("string")).alias("data_comentario"),
        F.when(F.col("lang") != "fr", (F.col("n_chars") % 20).cast("string")).alias("curtidas"),
        F.col("text").alias("texto_comentario"),
        doc.alias("posicao"),
    )


def silver_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments_silver(comments(spark, sf_dir), [F.asc("posicao")]).drop("posicao")


def gold_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_gold(silver_comments(spark, sf_dir), LEXICON)


def staged_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments_staging(gold_comments(spark, sf_dir))

