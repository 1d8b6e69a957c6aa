"""Dashboard marts over the star and the comment fact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions import defaults as d
from wardlake.functions.exact import half_up, mean3, percent
from wardlake.operators.keys import rank_descending
from wardlake.plans.star import Star
from wardlake.sources.storage import publish

TOTAL = "total_internacoes"


def _total() -> Column:
    return F.sum("qtd_internacoes").alias(TOTAL)


def _with_share(groups: DataFrame, measure: str, name: str) -> DataFrame:
    """Add each group's percentage of all. The grand total is a scalar subquery that reuses
    the shuffle of the groups; no window pulls them into one task."""
    whole = groups.agg(F.sum(measure)).scalar()
    return groups.withColumn(name, percent(F.col(measure), whole))


def sliced(star: Star, years: Iterable[int] | None = None, flag: str | None = None) -> DataFrame:
    """The fact under the dashboard's slicers: years, and capital or interior."""
    fact = star.fact
    if years is not None:
        days = star.time.filter(F.col("ano").isin(*years)).select("id_tempo")
        fact = fact.join(days, "id_tempo", "left_semi")
    if flag is not None:
        places = star.municipality.filter(F.col("capital_interior") == flag).select("id_municipio")
        fact = fact.join(places, "id_municipio", "left_semi")
    return fact


def top_specialties(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Question 1: admissions by specialty, ranked."""
    joined = (star.fact if fact is None else fact).join(star.specialty, "id_especialidade")
    totals = joined.groupBy("especialidade_padrao", "grupo_especialidade").agg(_total())
    ranked = rank_descending(totals, TOTAL, ["especialidade_padrao", "grupo_especialidade"], "ranking")
    return ranked.orderBy(F.desc(TOTAL), "especialidade_padrao")


def patient_profile(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Question 2: admissions and share by age band and sex."""
    joined = (star.fact if fact is None else fact).join(star.patient, "id_paciente")
    totals = joined.groupBy("faixa_etaria", "sexo").agg(_total())
    return _with_share(totals, TOTAL, "pct_total").orderBy(F.desc(TOTAL), "faixa_etaria", "sexo")


def municipality_totals(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Question 3: admissions and share by municipality."""
    joined = (star.fact if fact is None else fact).join(star.municipality, "id_municipio")
    totals = joined.groupBy("municipio_residencia", "capital_interior", "uf").agg(_total())
    return _with_share(totals, TOTAL, "pct_total").orderBy(F.desc(TOTAL), "municipio_residencia")


def monthly_seasonality(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Question 4: admissions by month, in calendar order."""
    joined = (star.fact if fact is None else fact).join(star.time, "id_tempo")
    return joined.groupBy("ano", "mes", "ano_mes", "nome_mes", "estacao_br").agg(_total()).orderBy("ano", "mes")


def season_totals(star: Star, fact: DataFrame | None = None) -> DataFrame:
    joined = (star.fact if fact is None else fact).join(star.time, "id_tempo")
    return joined.groupBy("estacao_br").agg(_total()).orderBy(F.desc(TOTAL), "estacao_br")


def comment_sample(comments: DataFrame, sentiment: str | None = None) -> DataFrame:
    """Question 5: comments with a short text, newest first; undated ones lead.

    The short rows are written before they are sorted, since a global sort reads its input
    twice and they are far smaller than the texts.
    """
    listed = comments if sentiment is None else comments.filter(F.col("sentimento") == sentiment)
    short = listed.select(
        "comment_id",
        "data_comentario",
        "autor",
        "curtidas",
        "sentimento",
        F.left("texto_limpo", F.lit(d.SUMMARY_LENGTH)).alias("texto_resumo"),
    )
    return publish(short, "listing").frame.orderBy(F.desc_nulls_first("data_comentario"), F.desc_nulls_first("curtidas"), "comment_id")


def sentiment_distribution(comments: DataFrame) -> DataFrame:
    """Question 6: comments, share and mean score by sentiment.

    The total is a window over the labels, of which there are three: a scalar subquery needs
    fewer columns than the groups do, so Spark would not share their work and judge all
    texts twice.
    """
    counts = comments.groupBy("sentimento").agg(
        F.count(F.lit(1)).alias("qtd_comentarios"), mean3(F.col("score_sentimento")).alias("score_medio")
    )
    whole = F.sum("qtd_comentarios").over(Window.partitionBy())
    shared = counts.withColumn("pct_comentarios", percent(F.col("qtd_comentarios"), whole))
    return shared.select("sentimento", "qtd_comentarios", "pct_comentarios", "score_medio").orderBy(
        F.desc("qtd_comentarios"), "sentimento"
    )


def decision_summary(star: Star, comments: DataFrame) -> DataFrame:
    """One row for the decision: total, leaders, shares of positive and negative comments.

    Each value is an uncorrelated scalar subquery; leaders tie-break by name, and a class
    without comments gives null.
    """
    places = star.fact.join(star.municipality, "id_municipio")
    kinds = star.fact.join(star.specialty, "id_especialidade")
    moods = publish(sentiment_distribution(comments), "moods").frame  # read by three subqueries

    def leader(df: DataFrame, name: str) -> Column:
        totals = df.groupBy(name).agg(_total())
        return totals.orderBy(F.desc(TOTAL), name).limit(1).select(name).scalar()

    def share(mood: str) -> Column:
        value = moods.filter(F.col("sentimento") == mood).select(half_up(F.col("pct_comentarios"), 1))
        return value.scalar()

    first_mood = moods.orderBy(F.desc("qtd_comentarios"), "sentimento").limit(1).select("sentimento").scalar()
    return star.fact.sparkSession.range(1).select(
        star.fact.agg(F.sum("qtd_internacoes")).scalar().alias("total_internacoes"),
        leader(kinds, "especialidade_padrao").alias("especialidade_lider"),
        leader(places, "municipio_residencia").alias("municipio_lider"),
        first_mood.alias("sentimento_predominante"),
        share(d.POSITIVE).alias("pct_positivo"),
        share(d.NEGATIVE).alias("pct_negativo"),
    )
