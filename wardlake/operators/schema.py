"""Operators on the columns of a frame: names, missing ones, NaN, lookups."""

from __future__ import annotations

import datetime
import unicodedata
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions import defaults as d


def plain_name(header: str) -> str:
    """Lower case, other Latin letters and signs spelled in ASCII, one blank between words."""
    spelled = header.lower().translate(str.maketrans(d.SPELLINGS))
    letters = (c for c in unicodedata.normalize("NFKD", spelled) if unicodedata.category(c) != "Mn")
    return " ".join("".join(letters).split())


def normalize_columns(df: DataFrame, aliases: Mapping[str, str] = d.ADMISSION_ALIASES) -> DataFrame:
    """Rename the columns: the name an alias stands for, or else the words of the header.

    Aliases and headers are compared as plain names. Two headers that end with the same name
    are an error. Only the schema is touched.
    """
    renamed: dict[str, str] = {}
    standard = {plain_name(alias): name for alias, name in aliases.items()}
    for header in df.columns:
        words = plain_name(header)
        name = standard.get(words) or "_".join(words.split(" "))
        if name in renamed:
            raise ValueError(f"{renamed[name]!r} and {header!r} both stand for {name}")
        renamed[name] = header
    return df.toDF(*renamed)


def with_missing(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Add the columns the frame lacks, as text constants or nulls."""
    absent = {
        name: F.lit(value).cast("string") for name, value in defaults.items() if name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating-point column."""
    floating = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floating) if floating else df


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def lookup_join(df: DataFrame, key: str, lookup: DataFrame, out: str, default: str) -> DataFrame:
    """Add ``out`` from a two-column lookup frame (key, value), or the default.

    For lookups too long for an expression. Of a repeated key the smallest value counts. A
    left join on unique keys, so no row is lost or doubled; Spark broadcasts the lookup if its size allows and shuffles both sides if not.
    A hot key only ever meets one lookup row, which adaptive skew joins split.
    """
    source, value = lookup.columns
    unique = lookup.groupBy(F.col(source).alias("_key")).agg(F.min(value).alias("_value"))
    joined = df.join(unique, df[key] == unique["_key"], "left")
    return joined.withColumn(out, F.coalesce("_value", F.lit(default))).drop("_key", "_value")


def period(df: DataFrame, date: str, years: Iterable[int] = d.STUDY_YEARS) -> DataFrame:
    """Rows of the listed years.

    Stated as date ranges, one per run of consecutive years, so that the filter reaches the
    scan; ``year(date)`` would not.
    """
    listed = sorted(set(years))
    condition = F.lit(False)
    start = 0
    for i, year in enumerate(listed):
        if i + 1 == len(listed) or listed[i + 1] != year + 1:
            first = F.lit(datetime.date(listed[start], 1, 1))
            after = F.lit(datetime.date(year + 1, 1, 1))
            condition = condition | ((F.col(date) >= first) & (F.col(date) < after))
            start = i + 1
    return df.filter(condition)
