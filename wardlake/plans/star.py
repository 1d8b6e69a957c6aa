"""Star schema: dimensions with dense keys, the admissions fact, the comment fact."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardlake.functions import cleaning as c
from wardlake.functions import defaults as d
from wardlake.operators.keys import dense_id
from wardlake.plans.admissions import date_parts
from wardlake.sources.storage import publish, TEXT_CODEC

NATURAL_KEYS = ("data_internacao", "especialidade_padrao", "faixa_etaria", "sexo", "idade", "municipio_residencia")
ATTRIBUTES = ("grupo_especialidade", "codigo_municipio_ibge", "capital_interior")
FACT_KEYS = ("id_tempo", "id_especialidade", "id_paciente", "id_municipio")


def _real_code() -> Column:
    """Of several codes, a real one wins over the sentinel, then the lowest."""
    code = F.col("codigo_municipio_ibge")
    real = F.min(F.when(code != d.UNKNOWN_CODE, code))
    return F.coalesce(real, F.lit(d.UNKNOWN_CODE)).alias("codigo_municipio_ibge")


def admissions_grain(staging: DataFrame) -> DataFrame:
    """Admissions summed by the natural keys of the dimensions, with ages made joinable.

    Everything in the star is a function of this frame, which is bounded by the
    combinations of the keys rather than by the rows of the source. Attributes that should
    depend on a key are reduced here, so that a row is a row of the fact.

    The source is summed by keys and attributes, which Spark does by hashing; the least of a
    text it finds by sorting, so that is left to these sums.
    """
    keyed = staging.withColumn("idade", c.age_key(F.col("idade")))
    summed = keyed.groupBy(*NATURAL_KEYS, *ATTRIBUTES).agg(F.sum("numero_internacoes").alias("qtd_internacoes"))
    return summed.groupBy(*NATURAL_KEYS).agg(
        F.sum("qtd_internacoes").alias("qtd_internacoes"),
        F.min("grupo_especialidade").alias("grupo_especialidade"),
        _real_code(),
        F.min("capital_interior").alias("capital_interior"),
    )


def _dimension(distinct: DataFrame, order: Sequence[str], key: str, **attributes: Column) -> DataFrame:
    """Distinct natural keys with their dense key, and columns derived from them.

    The rows are written once, by the numbering; what follows is a projection of them.
    """
    numbered = dense_id(distinct, [F.asc(name) for name in order], key)
    return numbered.withColumns(attributes) if attributes else numbered


def dim_time(grain: DataFrame, months: Sequence[str] = d.MONTH_NAMES) -> DataFrame:
    dates = grain.select("data_internacao").distinct().withColumns(date_parts("data_internacao"))
    return _dimension(
        dates,
        ["data_internacao"],
        "id_tempo",
        nome_mes=c.month_name(F.col("mes"), months),
        estacao_br=c.season(F.col("mes")),
    )


def dim_specialty(grain: DataFrame) -> DataFrame:
    """One row per specialty; of several groups the first by name, so that facts never double."""
    kinds = grain.groupBy("especialidade_padrao").agg(F.min("grupo_especialidade").alias("grupo_especialidade"))
    return _dimension(kinds, ["especialidade_padrao"], "id_especialidade")


def dim_patient(grain: DataFrame) -> DataFrame:
    profiles = grain.select("faixa_etaria", "sexo", "idade").distinct()
    return _dimension(profiles, ["faixa_etaria", "sexo", "idade"], "id_paciente")


def dim_municipality(grain: DataFrame, state: str = d.STATE) -> DataFrame:
    """One row per municipality, with one code and flag, so that facts never double."""
    places = grain.groupBy("municipio_residencia").agg(
        _real_code(), F.min("capital_interior").alias("capital_interior")
    )
    return _dimension(places, ["municipio_residencia"], "id_municipio", uf=F.lit(state))


@dataclass(frozen=True)
class Star:
    """The admissions star. ``admissions`` is the total of the staging rows it was built from,
    observed while they were read; None if it is not known."""

    time: DataFrame
    specialty: DataFrame
    patient: DataFrame
    municipality: DataFrame
    fact: DataFrame
    admissions: int | None = None


def fact_admissions(
    grain: DataFrame, time: DataFrame, specialty: DataFrame, patient: DataFrame, municipality: DataFrame
) -> DataFrame:
    """Admissions by the four dimension keys.

    A row of the grain is a row of the fact. No join is hinted: Spark broadcasts dimensions
    below its threshold and shuffles the others.
    """
    joined = (
        grain.select(*NATURAL_KEYS, "qtd_internacoes")
        .join(time.select("data_internacao", "id_tempo"), "data_internacao")
        .join(specialty.select("especialidade_padrao", "id_especialidade"), "especialidade_padrao")
        .join(patient, ["faixa_etaria", "sexo", "idade"])
        .join(municipality.select("municipio_residencia", "id_municipio"), "municipio_residencia")
    )
    return joined.select(*FACT_KEYS, "qtd_internacoes")


def build_star(staging: DataFrame, store_fact: bool = False) -> Star:
    """Star from staging rows. The staging plan runs once, for the stored grain; with
    ``store_fact`` the fact is written too, for callers that read it several times."""
    seen = Observation()
    total = F.sum("numero_internacoes").alias("total")
    grain = publish(admissions_grain(staging.observe(seen, total)), "grain").frame
    builders = {
        "time": dim_time, "specialty": dim_specialty, "patient": dim_patient, "municipality": dim_municipality,
    }
    with ThreadPoolExecutor(len(builders)) as pool:  # four small independent jobs
        dims = dict(zip(builders, pool.map(lambda build: build(grain), builders.values())))
    fact = fact_admissions(grain, **dims)
    if store_fact:
        fact = publish(fact, "fact").frame
    return Star(**dims, fact=fact, admissions=seen.get["total"] or 0)


def fact_comments(staging: DataFrame) -> DataFrame:
    """Comment-grain fact with a dense key in id order; it grows with the data.

    The rows are written with a key of their own, so that ids which repeat are numbered row
    by row. Only ids and row keys are sorted and numbered; the texts join them, so they cross
    the network once and are never sampled.
    """
    rows = publish(staging.withColumn("_row", F.monotonically_increasing_id()), "comments", TEXT_CODEC).frame
    ids = rows.select(F.col("comment_id").alias("_id"), F.col("_row").alias("_key"))
    numbered = dense_id(ids, [F.asc_nulls_last("_id"), F.asc("_key")], "id_comentario")
    joined = numbered.join(rows, F.col("_key") == F.col("_row"))
    return joined.select("id_comentario", *staging.columns)
