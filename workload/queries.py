"""One query per operator of the engine, over the given tables.

Dates leave a query as ISO text and decimals as doubles, so that any engine's result can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions import cleaning as c
from wardlake.functions import defaults as d
from wardlake.functions import text as t
from wardlake.operators.dedup import keep_first
from wardlake.operators.lexicon import lexicon_counts
from wardlake.operators.quality import (
    conflicting_attributes, layer_counts, null_counts, reconcile_total, repeated_keys, Watch,
)
from wardlake.operators.schema import lookup_join, nan_to_null, normalize_columns, period, with_missing
from wardlake.operators.terms import term_counts, term_ranks, tfidf_terms
from wardlake.plans import admissions as adm
from wardlake.plans import comments as com
from wardlake.plans import marts, star
from wardlake.plans.warehouse import build_warehouse
from wardlake.sources import readers, writers
from wardlake.sources.storage import new_path, publish
from workload import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LANGUAGES = ("de", "en", "es", "fr")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as doubles, integers as longs."""

    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema])


# --- Sources and sinks ---------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
    )


@query
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    path = new_path(spark, "orders_csv")
    writers.write_delimited(orders, path)
    text = readers.read_delimited(spark, path)
    return plain(text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema]))


@query
def q_csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with their quotes, separators, blanks and line breaks; no text is a marker of a missing one."""
    docs = a.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = new_path(spark, "documents_csv")
    writers.write_delimited(docs, path)
    text = readers.read_delimited(spark, path, multiline=True, null_markers=())
    return text.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


@query
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by year and copied; read back from the copy."""
    orders = _orders(spark, sf_dir).withColumn("ano", F.year("o_orderdate"))
    path, copy = new_path(spark, "orders"), new_path(spark, "orders_copy")
    writers.write_parquet(orders, path, partition_by="ano", copy_to=copy)
    return plain(spark.read.schema(orders.schema).parquet(copy))


@query
def q_partition_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the partitioned sink, totalled: only its folder is read."""
    orders = _orders(spark, sf_dir).withColumn("ano", F.year("o_orderdate"))
    path = new_path(spark, "orders_by_year")
    writers.write_parquet(orders, path, partition_by="ano")
    stored = spark.read.schema(orders.schema).parquet(path)
    return plain(
        stored.filter("ano = 1996").groupBy("ano", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    )


@query
def q_multi_file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by market segment in latin-1 files whose columns differ in order and number."""
    customer = a.table(spark, sf_dir, "customer").withColumn(
        "c_name", F.concat(F.lit("São "), "c_name")
    )
    base = new_path(spark, "customers")
    odd = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    first = customer.filter(~odd).select("c_custkey", "c_name", "c_mktsegment")
    second = customer.filter(odd).select("c_mktsegment", "c_nationkey", "c_name", "c_custkey")
    writers.write_delimited(first, f"{base}/a", encoding="ISO-8859-1")
    writers.write_delimited(second, f"{base}/b", encoding="ISO-8859-1")
    df = readers.read_delimited_dir(spark, f"{base}/*/*.csv", encoding="ISO-8859-1")
    return df.select(
        F.col("c_custkey").cast("long").alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        F.col("c_nationkey").cast("long").alias("c_nationkey"),
    )


@query
def q_source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing folder, an empty table, then the customers; says which one was taken."""
    name, df = readers.first_available(
        [
            ("missing", lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet")),
            ("empty", lambda: a.table(spark, sf_dir, "customer").filter("c_custkey IS NULL")),
            ("customer", lambda: a.table(spark, sf_dir, "customer")),
        ]
    )
    return df.select(F.lit(name).alias("source"), "c_custkey", "c_name")


def _payload_path(spark: SparkSession, sf_dir: str) -> str:
    """Conversations landed as service responses: one per twenty posts, a post per
    conversation and page of fifty turns, so no array grows with the data."""
    turn = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "text",
        F.when(F.col("role") != "system", F.col("role")).alias("username"),
        F.concat(F.lit("2024-01-0"), (F.col("turn") % 9 + 1).cast("string"), F.lit("T10:00:00+0000")).alias("timestamp"),
        F.when(F.col("turn") > 0, F.col("turn")).alias("like_count"),
    )
    posts = (
        a.table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / 50).alias("page"))
        .agg(F.array_agg(turn).alias("data"))
        .select("conv_id", "page", F.col("conv_id").cast("string").alias("id"), F.struct("data").alias("comments"))
    )
    responses = (
        posts.groupBy(F.floor(F.col("conv_id") / 20).alias("response"), "page")
        .agg(F.array_sort(F.array_agg(F.struct("conv_id", "id", "comments"))).alias("data"))
        .select(F.transform("data", lambda p: F.struct(p["id"].alias("id"), p["comments"].alias("comments"))).alias("data"))
    )
    path = new_path(spark, "payloads")
    responses.write.json(path)
    return path


@query
def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment of every post."""
    payloads = readers.read_payloads(spark, _payload_path(spark, sf_dir))
    return readers.flatten_comments(payloads)


@query
def q_json_flatten_first_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of the first ten posts of each response."""
    payloads = readers.read_payloads(spark, _payload_path(spark, sf_dir))
    return readers.flatten_comments(payloads, max_posts=10)


@query
def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in one file per nation: the rows, bytes and MD5 of each file."""
    customer = a.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = new_path(spark, "nations")
    by_nation = customer.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    writers.write_delimited(by_nation, path, partition_by="c_nationkey")
    seen = readers.provenance(spark, f"{path}/*/*.csv", readers.read_delimited(spark, f"{path}/*/*.csv"))
    nation = F.regexp_extract("source", r"c_nationkey=(\d+)", 1).cast("long").alias("c_nationkey")
    return seen.select(nation, "n_rows", "n_bytes", "file_hash")


def _loaded_twice(df: DataFrame, columns: dict[str, str], name: str) -> DataFrame:
    """The table after two loads: half of the rows, then all of them with the columns named in
    another order. The rows are read where the last load put them; the table itself is dropped."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"{name}_{path[-32:]}"
    writers.load_table(df.filter("mes <= 6" if "mes" in columns else "qtd_tokens > 100"), table, columns, path)
    loaded = writers.load_table(df, table, dict(reversed(columns.items())))
    schema, place = loaded.schema, writers.table_location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(schema).parquet(place)


@query
def q_staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_loaded_twice(a.silver_admissions(spark, sf_dir), adm.STAGING_TYPES, "stg_internacoes"))


@query
def q_staging_comments_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_loaded_twice(a.gold_comments(spark, sf_dir), com.STAGING_TYPES, "stg_comentarios"))


# --- Cleaning of admissions ----------------------------------------------------------


@query
def q_normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(a.raw_admissions(spark, sf_dir))


@query
def q_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = a.admissions(spark, sf_dir).select("especialidade_hospitalar", "numero_internacoes")
    added = with_missing(df, {"codigo_municipio_ibge": d.UNKNOWN_CODE, "autor": None, "numero_internacoes": "9"})
    return plain(added)


def _text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in seven forms, and in some that give no date."""
    date = F.to_date("o_orderdate")
    iso, slashed, compact = (F.date_format(date, p) for p in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd"))
    forms = (
        iso,
        F.date_format(date, "dd/MM/yyyy"),
        F.concat(iso, F.lit(" 10:30")),
        slashed,
        F.concat(iso, F.lit("T23:00:00Z")),
        F.concat(iso, F.lit(" 10:00:00.123")),
        compact,
        F.concat(F.lit("\t"), iso, F.lit("T01:02:03-03:00 ")),
        F.lit("31/02/1995"),
        F.lit("  "),
        F.lit(None).cast("string"),
        F.concat(iso, F.lit(" 25:00")),
    )
    text = F.element_at(F.array(*forms), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    return a.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("texto"))


@query
def q_date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _text_dates(spark, sf_dir).withColumn("data", c.date_or_null(F.col("texto")))
    return plain(df.filter(F.col("data").isNotNull()))


@query
def q_date_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows without a usable date and why, as the silver layer would drop them."""
    rejected = adm.rejected_dates(_text_dates(spark, sf_dir).withColumnRenamed("texto", "Data da Internação"))
    return rejected.select("o_orderkey", F.col("data_internacao").alias("texto"), "problema")


@query
def q_numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as text with blanks, bad and oversized ones; counts default to one."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "erro")
        .when(kind == "click", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("-"), F.col("value").cast("string")))
        .when(kind == "purchase", "1e20")
    )
    df = a.table(spark, sf_dir, "events").select("event_id", text.alias("texto"))
    return plain(df.withColumn("n", F.coalesce(c.whole_number(F.col("texto")), F.lit(1))).drop("texto"))


@query
def q_nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = a.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )
    return nan_to_null(df)


@query
def q_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    name = F.when(segment == "MACHINERY", F.lit(" \t ")).when(
        segment != "BUILDING", F.concat(F.lit(" "), segment, F.lit("\n"))
    )
    return a.table(spark, sf_dir, "customer").select(
        "c_custkey",
        c.or_sentinel(name).alias("municipio_residencia"),
        c.or_sentinel(F.nullif(F.col("c_nationkey").cast("string"), F.lit("7")), d.UNKNOWN_CODE).alias("codigo_municipio_ibge"),
    )


@query
def q_specialty_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as specialties: mapped where exact, otherwise title case."""
    part = a.table(spark, sf_dir, "part")
    raw = F.when(F.col("p_size") != 50, F.concat(F.lit(" "), "p_type", F.when(F.col("p_size") > 25, "-d'ÁGUA 3rd x").otherwise("")))
    return part.select("p_partkey", c.specialty(c.stripped(raw), a.SPECIALTY_NAMES).alias("especialidade_padrao"))


@query
def q_specialty_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups from a lookup frame by join, next to the same lookup as an expression."""
    lookup = spark.createDataFrame(list(a.SPECIALTY_GROUPS.items()), "nome string, grupo string")
    df = a.silver_admissions(spark, sf_dir).select("especialidade_padrao", "grupo_especialidade")
    joined = lookup_join(df, "especialidade_padrao", lookup, "grupo_por_join", d.OTHER_GROUP)
    return joined.groupBy("especialidade_padrao", "grupo_especialidade", "grupo_por_join").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def q_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = a.table(spark, sf_dir, "part")
    age = F.when(F.col("p_size") % 10 != 0, F.concat(((F.col("p_size") - 2) * 2).cast("string"), F.lit(".9")))
    banded = part.select("p_partkey", c.whole_number(age).alias("idade"))
    return plain(banded.withColumn("faixa_etaria", c.age_band(F.col("idade"))))


@query
def q_sex_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", " f ").when(status == "O", "Masculino").when(F.col("o_orderkey") > 100, "NI")
    return a.table(spark, sf_dir, "orders").select("o_orderkey", c.sex(raw).alias("sexo"))


@query
def q_capital_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = a.silver_admissions(spark, sf_dir)
    return df.groupBy("municipio_residencia", "capital_interior").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = a.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data"))
    return plain(df.withColumns(adm.date_parts("data")))


@query
def q_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of listed years; the range reaches the scan."""
    df = a.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    kept = period(df, "l_shipdate", (1996, 1997, 2000))
    return plain(kept.withColumn("l_shipdate", F.to_date("l_shipdate")))


@query
def q_admissions_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = adm.admissions_silver(
        a.raw_admissions(spark, sf_dir), groups={"Economy-D'Água": "Clínico"}, capital_pattern=a.CAPITAL_PATTERN
    )
    return plain(silver.drop("processed_at"))


@query
def q_fact_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(adm.fact_grain(a.silver_admissions(spark, sf_dir)))


@query
def q_gold_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adm.gold_monthly(a.silver_admissions(spark, sf_dir))


# --- Text and sentiment --------------------------------------------------------------


def _all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all documents and conversations, with a link, a mention and a tag added."""
    docs = a.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    turns = a.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text"
    )
    return docs.unionByName(turns).select(
        "id", F.concat(F.lit("Veja@joão_1 ahttps://x.y/é?z "), "text", F.lit(" #saúde-já")).alias("text")
    )


@query
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_texts(spark, sf_dir).select("id", t.clean_text(F.col("text")).alias("texto_limpo"))


@query
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_texts(spark, sf_dir).select("id", F.array_join(t.tokens(F.col("text")), " ").alias("tokens"))


@query
def q_token_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _all_texts(spark, sf_dir).select("id", t.tokens(F.col("text")).alias("words"))
    return plain(df.select("id", t.digest(F.col("words")).alias("tokens"), F.size("words").alias("qtd_tokens")))


@query
def q_lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _all_texts(spark, sf_dir).select("id", t.tokens(F.col("text")).alias("words"))
    return plain(
        df.select(
            "id",
            t.lexicon_hits(F.col("words"), a.LEXICON.positive).alias("positivos"),
            t.lexicon_hits(F.col("words"), a.LEXICON.negative).alias("negativos"),
        )
    )


@query
def q_lexicon_hits_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of the benchmark items as a lexicon over all texts."""
    items = a.table(spark, sf_dir, "benchmark").select(F.explode(t.tokens(F.col("text"))).alias("palavra"))
    lexicon = items.where("length(palavra) > 4").distinct()
    df = publish(_all_texts(spark, sf_dir).select("id", t.tokens(F.col("text")).alias("words")), "words").frame
    return lexicon_counts(df, "id", "words", lexicon, "acertos")


@query
def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = a.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    keyed = docs.withColumn("_digest", F.sha2("text", 256))
    return keep_first(keyed, ["_digest"], [F.asc("doc_id")]).drop("_digest")


@query
def q_comments_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ids that repeat: those of one source and length share one."""
    raw = a.comments(spark, sf_dir).withColumn("comment_id", F.concat_ws("-", "post_id", F.length("texto_comentario")))
    silver = com.comments_silver(raw.withColumnRenamed("autor", " AUTOR "), [F.asc("posicao")])
    return plain(silver.drop("processed_at"))


@query
def q_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = a.gold_comments(spark, sf_dir)
    return plain(gold.select("comment_id", "sentimento", "score_sentimento", "tokens", "qtd_tokens"))


@query
def q_sentiment_default_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default word lists over texts that carry phrases of both moods and neutral ones."""
    lang = F.col("autor")
    phrase = (
        F.when(lang == "es", "Não gostei da fila, péssima demora.")
        .when(lang == "fr", "Excelente, muito bom! Recomendo.")
        .when(lang == "de", "Normal, nem bom nem ruim.")
        .otherwise("Atendimento eficiente, mas lento.")
    )
    silver = a.silver_comments(spark, sf_dir)
    texts = silver.withColumn("texto_limpo", F.concat("texto_limpo", F.lit(" "), phrase))
    gold = com.sentiment_gold(texts)
    return plain(gold.select("comment_id", "sentimento", "score_sentimento", "qtd_tokens"))


@query
def q_tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = publish(a.gold_comments(spark, sf_dir).select("sentimento", "texto_limpo"), "gold").frame
    terms = tfidf_terms(gold, stopwords=a.TFIDF_STOPWORDS)
    return terms.withColumn("score_tfidf", F.round("score_tfidf", 6))


@query
def q_tfidf_given_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF over a stated vocabulary: the languages' classes and the words of one list."""
    docs = a.table(spark, sf_dir, "documents").select("lang", "text")
    listed = [(lang, word) for lang in LANGUAGES for word in ("the", "que", "der", "et", "und", "la", "of", "los")]
    vocabulary = spark.createDataFrame(listed, "classe string, termo string")
    terms = tfidf_terms(docs, "lang", "text", classes=LANGUAGES, vocabulary=vocabulary)
    return terms.withColumn("score_tfidf", F.round("score_tfidf", 6))


@query
def q_tfidf_large_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF over thousands of terms: the names of all documents' own words of eight letters."""
    docs = publish(a.table(spark, sf_dir, "documents").select("lang", "text"), "texts").frame
    vocabulary = docs.select("lang", F.explode(t.tokens(F.col("text"))).alias("termo")).where("length(termo) = 8").distinct()
    terms = tfidf_terms(docs, "lang", "text", classes=LANGUAGES, vocabulary=vocabulary)
    return terms.withColumn("score_tfidf", F.round("score_tfidf", 6))


@query
def q_tfidf_many_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two thousand most frequent terms of each language."""
    docs = publish(a.table(spark, sf_dir, "documents").select("lang", "text"), "texts").frame
    terms = tfidf_terms(docs, "lang", "text", classes=LANGUAGES, top=2000)
    return terms.withColumn("score_tfidf", F.round("score_tfidf", 6))


@query
def q_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop list is a frame."""
    stopwords = spark.createDataFrame([(w,) for w in d.COUNT_STOPWORDS], "palavra string")
    return plain(term_counts(a.staged_comments(spark, sf_dir), stopwords=stopwords))


@query
def q_term_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(term_ranks(term_counts(a.staged_comments(spark, sf_dir))))


# --- Star ----------------------------------------------------------------------------


def _grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.admissions_grain(a.staged_admissions(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str, store_fact: bool = False) -> star.Star:
    return star.build_star(a.staged_admissions(spark, sf_dir), store_fact)


@query
def q_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.dim_time(_grain(spark, sf_dir)))


@query
def q_dim_specialty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_specialty(_grain(spark, sf_dir))


@query
def q_dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.dim_patient(_grain(spark, sf_dir)))


@query
def q_dim_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_municipality(_grain(spark, sf_dir))


@query
def q_fact_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).fact


@query
def q_fact_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.fact_comments(a.staged_comments(spark, sf_dir)))


@query
def q_fact_comments_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that repeat: every row has a number of its own; the numbers of an id follow each other."""
    staged = a.staged_comments(spark, sf_dir).withColumn("comment_id", F.col("post_id"))
    fact = star.fact_comments(staged)
    return fact.groupBy("comment_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id_comentario").alias("n_keys"),
        F.min("id_comentario").alias("first_key"),
        F.max("id_comentario").alias("last_key"),
    )


def _two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged admissions whose specialties have another group in the second half of a year."""
    return a.staged_admissions(spark, sf_dir).withColumn(
        "grupo_especialidade", F.when(F.col("mes") > 6, F.lit("Segundo")).otherwise(F.col("grupo_especialidade"))
    )


@query
def q_fact_two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by specialty where a specialty has two groups: one row each, nothing doubled."""
    return marts.top_specialties(star.build_star(_two_groups(spark, sf_dir)))


@query
def q_check_two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicting_attributes(_two_groups(spark, sf_dir), "especialidade_padrao", "grupo_especialidade")


# --- Marts ---------------------------------------------------------------------------


@query
def q_top_specialties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_specialties(_star(spark, sf_dir))


@query
def q_patient_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.patient_profile(_star(spark, sf_dir))


@query
def q_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.municipality_totals(_star(spark, sf_dir))


@query
def q_monthly_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.monthly_seasonality(_star(spark, sf_dir)))


@query
def q_season_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.season_totals(_star(spark, sf_dir))


@query
def q_sliced_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _star(spark, sf_dir)
    return marts.patient_profile(built, marts.sliced(built, years=(1996, 1997), flag=d.CAPITAL))


@query
def q_top_n_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.municipality_totals(_star(spark, sf_dir)).limit(5)


@query
def q_top_n_specialties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_specialties(_star(spark, sf_dir)).limit(10)


@query
def q_comment_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.comment_sample(a.staged_comments(spark, sf_dir)))


@query
def q_comment_sample_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.comment_sample(a.staged_comments(spark, sf_dir), d.POSITIVE))


@query
def q_sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sentiment_distribution(a.staged_comments(spark, sf_dir))


@query
def q_decision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.decision_summary(_star(spark, sf_dir, store_fact=True), a.staged_comments(spark, sf_dir))


@query
def q_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole warehouse written to a folder; its views asked in SQL."""
    build_warehouse(
        a.admissions(spark, sf_dir),
        a.comments(spark, sf_dir),
        [F.asc("posicao")],
        new_path(spark, "warehouse"),
        lexicon=a.LEXICON,
        silver_options={
            "names": a.SPECIALTY_NAMES, "groups": a.SPECIALTY_GROUPS, "capital_pattern": a.CAPITAL_PATTERN,
        },
    )
    return spark.sql(
        """
        SELECT 'specialty' AS mart, especialidade_padrao AS label, total_internacoes AS measure FROM vw_top_especialidades
        UNION ALL SELECT 'profile', faixa_etaria || ' ' || sexo, total_internacoes FROM vw_perfil_paciente
        UNION ALL SELECT 'municipality', municipio_residencia, total_internacoes FROM vw_internacoes_municipio
        UNION ALL SELECT 'month', ano_mes, total_internacoes FROM vw_sazonalidade_mensal
        UNION ALL SELECT 'sentiment', sentimento, qtd_comentarios FROM vw_sentimento_distribuicao
        UNION ALL SELECT 'term', sentimento || ' ' || termo, CAST(score_tfidf AS BIGINT) FROM vw_termos_frequentes
        UNION ALL SELECT 'comment', comment_id, CAST(curtidas AS BIGINT) FROM vw_comentarios_amostra
        UNION ALL SELECT 'leader', especialidade_lider || ' ' || municipio_lider, total_internacoes FROM vw_resumo_decisao
        """
    )


# --- Data quality --------------------------------------------------------------------


@query
def q_check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns of admissions whose dates and municipalities were not cleaned."""
    raw = normalize_columns(a.raw_admissions(spark, sf_dir))
    required = ("data_internacao", "especialidade_hospitalar", "municipio_residencia", "idade", "numero_internacoes")
    return null_counts(raw, required)


@query
def q_check_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The required columns of both staging tables, over rows that lack some of them."""
    silver = adm.admissions_silver(a.raw_admissions(spark, sf_dir))
    thinned = adm.admissions_staging(silver).withColumn("sexo", F.when(F.col("idade") > 20, F.col("sexo")))
    staged = a.staged_comments(spark, sf_dir).withColumn("sentimento", F.nullif("sentimento", F.lit(d.NEUTRAL)))
    checks = {"internacoes": (thinned, adm.STAGING_REQUIRED), "comentarios": (staged, com.STAGING_REQUIRED)}
    parts = [null_counts(df, required).withColumn("tabela", F.lit(name)) for name, (df, required) in checks.items()]
    return parts[0].unionByName(parts[1])


@query
def q_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that several documents share, with their number."""
    return repeated_keys(a.table(spark, sf_dir, "documents"), ["text"])


@query
def q_check_unique_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many fact rows there are, and how many of their keys repeat."""
    fact = _star(spark, sf_dir, store_fact=True).fact
    return layer_counts({"fact": fact, "repeated": repeated_keys(fact, star.FACT_KEYS)})


def _conflicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged admissions where some rows of some municipalities lack their code."""
    code = F.col("codigo_municipio_ibge")
    unknown = (F.col("sexo") == d.UNKNOWN) & (F.length(code) == 1)
    return a.staged_admissions(spark, sf_dir).withColumn(
        "codigo_municipio_ibge", F.when(unknown, d.UNKNOWN_CODE).otherwise(code)
    )


@query
def q_check_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicting_attributes(_conflicted(spark, sf_dir), "municipio_residencia", "codigo_municipio_ibge")


@query
def q_dim_municipality_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension built from conflicting codes: one row each, the real code kept."""
    return star.dim_municipality(_conflicted(spark, sf_dir))


@query
def q_check_null_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' customers against their order status, which is missing at times: a null is a value."""
    orders = a.table(spark, sf_dir, "orders").select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return conflicting_attributes(orders, "o_custkey", "status")


@query
def q_check_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging, totalled while the star was built from it, against the fact when codes
    conflict: no row lost, none doubled."""
    built = star.build_star(_conflicted(spark, sf_dir))
    return reconcile_total(built.admissions, built.fact, "qtd_internacoes")


@query
def q_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the layers, seen in the two writes that compute them."""
    watch = Watch()
    silver = watch.over(adm.admissions_silver(watch.over(a.raw_admissions(spark, sf_dir), "bronze")), "silver")
    publish(watch.over(silver.select(*adm.MONTHLY_KEYS).distinct(), "gold"), "gold")
    publish(watch.over(a.silver_comments(spark, sf_dir).select("comment_id"), "comments"), "comments")
    return watch.report(spark).select("layer", F.col("value").alias("n_rows"))
