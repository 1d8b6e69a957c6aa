"""Admissions: bronze text to the silver layer, and the gold frames derived from it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import cleaning as c
from wardlake.functions import defaults as d
from wardlake.operators.quality import unused_name
from wardlake.operators.schema import is_text, normalize_columns, period, with_missing

STAGING_TYPES = {name: kind for name, kind, _ in d.ADMISSION_TABLE}
STAGING_REQUIRED = tuple(name for name, _, required in d.ADMISSION_TABLE if required)
GRAIN_COLUMNS = tuple(name for name in STAGING_TYPES if name != "especialidade_hospitalar")
MONTHLY_KEYS = (
    "ano_mes", "especialidade_padrao", "municipio_residencia", "faixa_etaria", "sexo", "capital_interior",
)


def dated(df: DataFrame, name: str, formats: Sequence[str] = d.DATE_FORMATS) -> Column:
    """A date column whatever the input holds: text is parsed, timestamps are cut."""
    return c.date_or_null(F.col(name), formats) if is_text(df, name) else F.to_date(name)


def date_parts(date: str) -> dict[str, Column]:
    return {
        "ano": F.year(date),
        "mes": F.month(date),
        "ano_mes": c.month_text(F.col(date)),
        "trimestre": F.quarter(date),
    }


def admissions_silver(
    df: DataFrame,
    aliases: Mapping[str, str] = d.ADMISSION_ALIASES,
    names: Mapping[str, str] = d.SPECIALTY_NAMES,
    groups: Mapping[str, str] = d.SPECIALTY_GROUPS,
    capital_pattern: str = d.CAPITAL_PATTERN,
    formats: Sequence[str] = d.DATE_FORMATS,
    years: Iterable[int] | None = None,
    by_year: bool = False,
) -> DataFrame:
    """Cleaned admissions: one narrow pass, no shuffle; further input columns are kept.

    Rows without a usable date are dropped, and those of other than the given years. A missing
    or unusable count is one admission. With ``by_year`` the rows are dealt out by year, for a
    write by year: that is done before the columns are derived, as these are more than twice
    as wide as what they come from.
    """
    df = normalize_columns(df, aliases)
    df = with_missing(df, {"codigo_municipio_ibge": d.UNKNOWN_CODE, "numero_internacoes": None})
    rows = df.withColumn("data_internacao", dated(df, "data_internacao", formats)).filter(F.col("data_internacao").isNotNull())
    if years is not None:
        rows = period(rows, "data_internacao", years)
    year = unused_name("_ano", df.columns)
    if by_year:
        rows = rows.withColumn(year, F.year("data_internacao")).hint("rebalance", F.col(year)).drop(year)
    typed = rows.withColumns(
        {
            "_especialidade": c.stripped(F.col("especialidade_hospitalar")),
            "idade": c.whole_number(F.col("idade"), is_text(df, "idade")),
            "sexo": c.sex(F.col("sexo_paciente")),
            "municipio_residencia": c.or_sentinel(F.col("municipio_residencia")),
            "codigo_municipio_ibge": F.coalesce(
                F.col("codigo_municipio_ibge").cast("string"), F.lit(d.UNKNOWN_CODE)
            ),
            "numero_internacoes": F.coalesce(
                c.whole_number(F.col("numero_internacoes"), is_text(df, "numero_internacoes")), F.lit(1)
            ),
        }
    )
    named = typed.withColumn("especialidade_padrao", c.specialty(F.col("_especialidade"), names))
    return named.drop("_especialidade").withColumns(
        {
            "grupo_especialidade": c.specialty_group(F.col("especialidade_padrao"), groups),
            "faixa_etaria": c.age_band(F.col("idade")),
            **date_parts("data_internacao"),
            "capital_interior": c.capital_flag(F.col("municipio_residencia"), capital_pattern),
            "processed_at": c.processing_time(),
        }
    )


def rejected_dates(
    df: DataFrame, aliases: Mapping[str, str] = d.ADMISSION_ALIASES, formats: Sequence[str] = d.DATE_FORMATS
) -> DataFrame:
    """The rows that ``admissions_silver`` drops, with the reason in ``problema``."""
    df = normalize_columns(df, aliases)
    if is_text(df, "data_internacao"):
        problem = c.date_problem(F.col("data_internacao"), formats)
    else:
        problem = F.when(F.col("data_internacao").isNull(), "missing")
    return df.withColumn("problema", problem).filter(F.col("problema").isNotNull())


def fact_grain(silver: DataFrame) -> DataFrame:
    return silver.select(*GRAIN_COLUMNS)


def admissions_staging(silver: DataFrame) -> DataFrame:
    """The staging columns in their table types."""
    return silver.select(*[F.col(name).cast(kind).alias(name) for name, kind in STAGING_TYPES.items()])


def gold_monthly(silver: DataFrame) -> DataFrame:
    """Admissions per month, specialty, municipality, band, sex and flag, largest first."""
    total = silver.groupBy(*MONTHLY_KEYS).agg(F.sum("numero_internacoes").alias("qtd_internacoes"))
    return total.orderBy(F.desc("qtd_internacoes"), *MONTHLY_KEYS)
