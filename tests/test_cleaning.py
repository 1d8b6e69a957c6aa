"""Cleaning expressions on edge values."""

import datetime
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wardlake.functions import cleaning as c
from wardlake.functions import defaults as d
from wardlake.functions import exact
from wardlake.functions import text as t
from wardlake.operators.schema import (
    lookup_join, nan_to_null, normalize_columns, period, with_missing,
)
from wardlake.plans.admissions import admissions_silver, dated, rejected_dates


def mapped(spark, expression, values, kind="string"):
    """Values of an expression over one column ``v``, in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_age_band(spark):
    ages = [None, "-1", "0", "17", "17.9", "18", "39", "40", "59", "60", "120", "x"]
    bands = ["Não informado", "0-17", "0-17", "0-17", "0-17", "18-39", "18-39", "40-59", "40-59", "60+", "60+", "Não informado"]
    assert mapped(spark, lambda v: c.age_band(c.whole_number(v)), ages) == bands
    numbers = [float("nan"), 17.9, 60.0]
    assert mapped(spark, lambda v: c.age_band(c.whole_number(v, False)), numbers, "double") == ["Não informado", "0-17", "60+"]


def test_sex(spark):
    raw = [" m ", "Masculino", "1", "f", "2", "\tFEMININO\n", "NI", "1.0", None, ""]
    want = ["Masculino"] * 3 + ["Feminino"] * 3 + ["Não informado"] * 4
    assert mapped(spark, c.sex, raw) == want


def test_specialty(spark):
    raw = ["CLINICA MEDICA", " Clinica Medica ", "clinica medica", "clinica-médica D'AGUA 3rd", None, "", "UTI"]
    want = ["Clínica Médica", "Clínica Médica", "Clinica Medica", "Clinica-Médica D'Agua 3Rd", "Não informado", "", "UTI"]
    assert mapped(spark, lambda v: c.specialty(c.stripped(v)), raw) == want


def test_title_case_is_that_of_text(spark):
    raw = ["são JOÃO", "a", "ÁGUA-viva 2x", "x1y2", "d'ávila  e o'neil", "ção/ÇÃO", "élan vital", "  ", "MiXeD cAsE", "ñandú_b"]
    assert mapped(spark, c.title_case, raw) == [v.title() for v in raw]


def test_group(spark):
    names = ["Cardiologia", "UTI", "Não informado", "Urologia"]
    assert mapped(spark, c.specialty_group, names) == ["Clínico", "Terapia Intensiva", "Outros", "Outros"]


def test_group_by_join_keeps_every_row(spark):
    lookup = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, g string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "name string")
    out = lookup_join(df, "name", lookup, "grp", "Outros")
    assert out.columns == ["name", "grp"]
    assert sorted(map(str, out.collect())) == sorted(
        ["Row(name='a', grp='x')", "Row(name='b', grp='y')", "Row(name='c', grp='Outros')", "Row(name=None, grp='Outros')"]
    )


def test_capital_flag(spark):
    assert mapped(spark, c.capital_flag, ["NATAL", "Natalândia", "Mossoró", ""]) == ["Capital", "Capital", "Interior", "Interior"]


def test_whole_number(spark):
    raw = [None, "x", "2.9", "-2.9", " 3 ", "12d", "12F", "nan", "inf", "1e20", "1e3", "", "45.0"]
    want = [None, None, 2, -2, 3, None, None, None, None, None, 1000, None, 45]
    assert mapped(spark, c.whole_number, raw) == want


def test_dates(spark):
    raw = ["2024-02-29", " 29/02/2024 ", "2023-02-29", "hoje", None, "", "31/12/1999", "2024-02-29 23:59:59", "2024-02-29T00:00:01", "2024-02-29 x"]
    leap = datetime.date(2024, 2, 29)
    assert mapped(spark, c.date_or_null, raw) == [leap, leap, None, None, None, None, datetime.date(1999, 12, 31), leap, leap, None]


def test_date_forms(spark):
    day = datetime.date(2024, 1, 5)
    good = ["2024-01-05", "05/01/2024", "2024-01-05 10:30", "2024/01/05", "2024-01-05T10:00:00Z", "2024-01-05 10:00:00.123", "20240105",
            "2024-01-05T23:59:59+05:30", "2024-01-05 23:59:59 -0300", "05/01/2024 08:00"]
    bad = ["2024-01-05 24:00", "2024-13-05", "2024-01-05 10", "202401051", "x2024-01-05"]
    assert mapped(spark, c.date_or_null, good) == [day] * len(good)
    assert mapped(spark, c.date_or_null, bad) == [None] * len(bad)
    assert mapped(spark, c.date_problem, [*good[:1], *bad[:1], "", " \t", None]) == [None, "unreadable", "blank", "blank", "missing"]


def test_rejected_dates_are_the_dropped_rows(spark):
    df = spark.createDataFrame([("2024-01-05", "a"), ("??", "b"), (None, "c")], ["Data da Internação", "especialidade"])
    assert {(r.especialidade_hospitalar, r.problema) for r in rejected_dates(df).collect()} == {("b", "unreadable"), ("c", "missing")}


def test_headers_are_spelled_in_ascii(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Data – Internação", "Straße", "Ørsted  Æble", "ﬁm"])
    assert normalize_columns(df).columns == ["data_-_internacao", "strasse", "orsted_aeble", "fim"]


def test_timestamps_are_cut_to_dates(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-05-01 23:59:59' AS x")
    assert df.select(dated(df, "x")).first()[0] == datetime.date(2024, 5, 1)


def test_sentinels(spark):
    assert mapped(spark, c.or_sentinel, [None, " a\t", "   ", " b "]) == ["Não informado", "a", "", "b"]


def test_season_and_month_name(spark):
    months = list(range(1, 13))
    seasons = ["Verão"] * 2 + ["Outono"] * 3 + ["Inverno"] * 3 + ["Primavera"] * 3 + ["Verão"]
    assert mapped(spark, c.season, months, "int") == seasons
    assert mapped(spark, c.month_name, months, "int") == list(d.MONTH_NAMES)


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], [" Data da Internação ", "ESPECIALIDADE", "Município", "Nº  do Leito", "número de internações"])
    assert normalize_columns(df).columns == [
        "data_internacao", "especialidade_hospitalar", "municipio_residencia", "no_do_leito", "numero_internacoes",
    ]
    twice = spark.createDataFrame([(1, 2)], ["Sexo", "sexo do paciente"])
    with pytest.raises(ValueError, match="sexo_paciente"):
        normalize_columns(twice)


def test_with_missing(spark):
    df = with_missing(spark.createDataFrame([("x",)], "a string"), {"a": "y", "b": "z", "c": None})
    assert df.first().asDict() == {"a": "x", "b": "z", "c": None}


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1, "NaN"), (2.0, None, None)], "x double, y int, z string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1, "NaN"), (2.0, None, None)]


def test_period(spark):
    days = [datetime.date(y, m, x) for y in (2022, 2023, 2024, 2025, 2026) for m, x in ((1, 1), (12, 31))] + [None]
    df = spark.createDataFrame([(v,) for v in days], "day date")
    assert {r.day.year for r in period(df, "day").collect()} == {2024, 2025}
    assert {r.day.year for r in period(df, "day", (2022, 2024, 2025)).collect()} == {2022, 2024, 2025}
    assert period(df, "day", ()).count() == 0


def test_silver_without_optional_columns(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "PEDIATRIA", "Natal ", "7", "F"), ("05/06/2025", None, None, None, None), ("??", "UTI", "x", "1", "M")],
        ["data_internacao", "especialidade", "município", "idade", "sexo"],
    )
    rows = {r["data_internacao"]: r.asDict() for r in admissions_silver(df).collect()}
    assert len(rows) == 2
    first, second = rows[datetime.date(2024, 1, 5)], rows[datetime.date(2025, 6, 5)]
    assert (first["especialidade_padrao"], first["grupo_especialidade"]) == ("Pediatria", "Pediatria")
    assert (first["municipio_residencia"], first["codigo_municipio_ibge"]) == ("Natal", "0000000")
    assert (first["capital_interior"], first["sexo"], first["faixa_etaria"], first["idade"]) == ("Capital", "Feminino", "0-17", 7)
    assert (first["numero_internacoes"], first["ano_mes"], first["trimestre"]) == (1, "2024-01", 1)
    assert (second["especialidade_padrao"], second["grupo_especialidade"]) == ("Não informado", "Outros")
    assert (second["municipio_residencia"], second["sexo"], second["faixa_etaria"]) == ("Não informado",) * 3
    assert first["processed_at"] == second["processed_at"]
    datetime.datetime.fromisoformat(first["processed_at"])


def test_round3_follows_the_binary_value(spark):
    values = [(2 * k + 1) / 2000 for k in range(1000)] + [3 / 16, 5 / 16, 1 / 16, -1 / 80, -0.0001, 0.0]
    values += [-v for v in values[:200]]
    assert mapped(spark, t.round3, values, "double") == [round(v, 3) for v in values]


def test_percent_is_decimal_half_up(spark):
    pairs = [(part, total) for total in (1, 3, 7, 8, 16, 400, 1000, 13964) for part in range(0, total + 1, max(1, total // 50))]
    df = spark.createDataFrame(pairs, "p long, t long").select("p", "t", exact.percent(F.col("p"), F.col("t")).alias("x"))
    for p, total, x in df.collect():
        quotient = Fraction(10000 * p, total)
        assert x == int(quotient + Fraction(1, 2)) / 100
    empty = spark.createDataFrame([(0, 0)], "p long, t long")
    assert empty.select(exact.percent(F.col("p"), F.col("t"))).first()[0] is None


def test_mean3_rounds_away_from_zero(spark):
    groups = {"a": [0.125, 0.126], "b": [-0.125, -0.126], "c": [0.0, 0.001], "d": [1.0, -1.0, 0.333], "e": []}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("e", None)]
    df = spark.createDataFrame(rows, "g string, v double").groupBy("g").agg(exact.mean3(F.col("v")).alias("m"))
    got = {r.g: r.m for r in df.collect()}
    for g, vs in groups.items():
        if not vs:
            assert got[g] is None
            continue
        mean = sum(Decimal(str(v)) for v in vs) / len(vs)
        assert got[g] == float(mean.quantize(Decimal("0.001"), ROUND_HALF_UP))


def test_half_up(spark):
    assert mapped(spark, lambda v: exact.half_up(v, 1), [12.25, 12.24, 0.05, None], "double") == [12.3, 12.2, 0.1, None]
