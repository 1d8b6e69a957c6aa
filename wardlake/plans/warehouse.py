"""The whole warehouse in one folder: layers, star and terms as tables, marts as views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame

from wardlake.functions import defaults as d
from wardlake.functions.text import Lexicon
from wardlake.operators.quality import Watch
from wardlake.operators.terms import term_counts, term_ranks, tfidf_terms
from wardlake.plans import admissions as adm
from wardlake.plans import comments as com
from wardlake.plans import marts
from wardlake.plans.star import Star, build_star, fact_comments
from wardlake.sources.storage import passing_steps, TEXT_CODEC
from wardlake.sources.writers import write_parquet


def build_warehouse(
    admissions: DataFrame,
    comments: DataFrame,
    comment_order: Sequence[Column],
    folder: str,
    years: Sequence[int] | None = None,
    lexicon: Lexicon = Lexicon(),
    silver_options: Mapping[str, Any] | None = None,
    sources: DataFrame | None = None,
    copy_to: str | None = None,
) -> dict[str, DataFrame]:
    """Write every layer below ``folder`` and register tables and marts as temporary views.

    Each layer is computed from the written one before it, so no step is run twice. Returns
    the registered frames by view name; ``camadas`` among them has the rows, nulls of required
    columns and totals of the layers, seen while they were written. ``folder`` is any URI the cluster can write to; the
    silver admissions are also written below ``copy_to``, and ``sources``, the provenance of
    the files read, is kept with the layers.

    Rows are dealt out by year once, for the silver admissions; the tables by year that are made
    of these are written as the rows lie. Steps of a table are deleted when it is written.
    """
    spark = admissions.sparkSession

    def stored(df: DataFrame, name: str, partition_by: str | None = None, copy: bool = False) -> DataFrame:
        path = f"{folder}/{name}"
        copied = f"{copy_to}/{name}" if copy and copy_to else None
        write_parquet(df, path, partition_by, copied, dealt=partition_by is not None, codec=TEXT_CODEC)
        return spark.read.schema(df.schema).parquet(path)

    watch = Watch()
    bronze = watch.over(admissions, "bronze/internacoes")
    cleaned = adm.admissions_silver(bronze, years=years, by_year=True, **(silver_options or {}))
    if sources is not None:
        stored(sources, "bronze/procedencia")
    silver = stored(watch.over(cleaned, "silver/internacoes"), "silver/internacoes", partition_by="ano", copy=True)
    stored(watch.over(adm.gold_monthly(silver), "gold/agregado_mensal"), "gold/agregado_mensal")
    stored(adm.fact_grain(silver), "gold/fato_grao", partition_by="ano")
    staged_rows = watch.over(adm.admissions_staging(silver), "staging/internacoes", adm.STAGING_REQUIRED, ["numero_internacoes"])
    staging = stored(staged_rows, "staging/internacoes", partition_by="ano")
    built = build_star(staging)

    watched = watch.over(comments, "bronze/comentarios")
    clean = stored(watch.over(com.comments_silver(watched, comment_order), "silver/comentarios"), "silver/comentarios")
    gold = stored(com.sentiment_gold(clean, lexicon), "gold/comentarios_sentimento")
    staged = stored(watch.over(com.comments_staging(gold), "staging/comentarios", com.STAGING_REQUIRED), "staging/comentarios")
    with passing_steps(spark):
        comment_facts = stored(fact_comments(staged), "olap/fato_sentimento_comentario")
    with passing_steps(spark):
        tfidf = stored(tfidf_terms(gold, stopwords=(*lexicon.words, *d.TFIDF_EXTRA_STOPWORDS)), "gold/termos_tfidf")
    tables = {
        "dim_tempo": stored(built.time, "olap/dim_tempo"),
        "dim_especialidade": stored(built.specialty, "olap/dim_especialidade"),
        "dim_paciente": stored(built.patient, "olap/dim_paciente"),
        "dim_municipio": stored(built.municipality, "olap/dim_municipio"),
        "fato_internacao": stored(watch.over(built.fact, "olap/fato_internacao", (), ["qtd_internacoes"]), "olap/fato_internacao"),
        "fato_sentimento_comentario": comment_facts,
        "dim_termo_sentimento": stored(term_counts(staged), "olap/dim_termo_sentimento"),
        "termos_tfidf": tfidf,
    }
    star = Star(
        time=tables["dim_tempo"],
        specialty=tables["dim_especialidade"],
        patient=tables["dim_paciente"],
        municipality=tables["dim_municipio"],
        fact=tables["fato_internacao"],
        admissions=built.admissions,
    )
    views = {
        "camadas": watch.report(spark),
        "stg_internacoes": staging,
        "stg_comentarios": staged,
        **tables,
        "vw_top_especialidades": marts.top_specialties(star),
        "vw_perfil_paciente": marts.patient_profile(star),
        "vw_internacoes_municipio": marts.municipality_totals(star),
        "vw_sazonalidade_mensal": marts.monthly_seasonality(star),
        "vw_comentarios_amostra": marts.comment_sample(tables["fato_sentimento_comentario"]),
        "vw_sentimento_distribuicao": marts.sentiment_distribution(tables["fato_sentimento_comentario"]),
        "vw_termos_frequentes": term_ranks(tables["dim_termo_sentimento"]),
        "vw_resumo_decisao": marts.decision_summary(star, tables["fato_sentimento_comentario"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
