"""Column expressions that clean and standardize admission values.

All of them are built-in Spark functions, so they stay inside whole-stage code generation
or at least inside the JVM; no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.functions import defaults as d


def stripped(c: Column) -> Column:
    """Text without leading and trailing white space of any kind (not only blanks)."""
    return F.btrim(c.cast("string"), F.lit(d.SPACE_CHARS))


def or_sentinel(c: Column, sentinel: str = d.UNKNOWN) -> Column:
    """Null becomes the sentinel, the rest is stripped; blank text stays ``''``."""
    return stripped(F.coalesce(c.cast("string"), F.lit(sentinel)))


def date_or_null(c: Column, formats: Sequence[str] = d.DATE_FORMATS) -> Column:
    """First declared format that parses, as a date; null if none does.

    A time of day behind the date is cut off, with its offset: the date is the one written.
    """
    text = F.regexp_replace(stripped(c), f"(?<=[0-9]){d.TIME_OF_DAY}$", "")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def date_problem(c: Column, formats: Sequence[str] = d.DATE_FORMATS) -> Column:
    """Why a text gives no date: ``missing``, ``blank`` or ``unreadable``; null if it gives one."""
    text = stripped(c)
    return (
        F.when(c.isNull(), "missing")
        .when(text == "", "blank")
        .when(date_or_null(c, formats).isNull(), "unreadable")
    )


def whole_number(c: Column, from_text: bool = True) -> Column:
    """Number cut to an integer toward zero; null for anything that is not one.

    Goes through double because ``'45.0'`` is not an integer literal. Text such as ``12d``,
    which a cast accepts as a Java-style literal, is not a number here.
    """
    if from_text:
        text = stripped(c)
        c = F.when(~F.upper(F.right(text, F.lit(1))).isin("D", "F"), text)
    return c.try_cast("double").try_cast("int")


def looked_up(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small mapping for ``c``, null when absent; see ``lookup_join`` for large ones."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[c]


def title_case(c: Column) -> Column:
    """First letter of every run of letters in upper case, the others in lower case.

    ``initcap`` does this for words between blanks, which is most of them; it only starts a
    word after a blank, so ``D'AGUA`` and ``CLINICA-MEDICA`` need the split into runs.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(
        runs,
        lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substr(run, F.lit(2)))),
    )
    return F.when(c.rlike(r"^[\p{L} ]*$"), F.initcap(c)).otherwise(F.array_join(cased, ""))


def specialty(c: Column, names: Mapping[str, str] = d.SPECIALTY_NAMES) -> Column:
    """Standard name of a stripped text by exact match, otherwise title case; null becomes
    the sentinel."""
    return F.coalesce(looked_up(c, names), title_case(c), F.lit(d.UNKNOWN))


def specialty_group(
    c: Column, groups: Mapping[str, str] = d.SPECIALTY_GROUPS, other: str = d.OTHER_GROUP
) -> Column:
    return F.coalesce(looked_up(c, groups), F.lit(other))


def age_band(
    age: Column, bands: Sequence[tuple[int, str]] = d.AGE_BANDS, oldest: str = d.OLDEST_BAND
) -> Column:
    """Band of an integer age; upper limits are inclusive, negative ages are in the first."""
    result = F.when(age.isNull(), F.lit(d.UNKNOWN))
    for upper, label in bands:
        result = result.when(age <= upper, F.lit(label))
    return result.otherwise(F.lit(oldest))


def sex(c: Column, codes: Mapping[str, Sequence[str]] = d.SEX_CODES) -> Column:
    labels = {code: label for label, accepted in codes.items() for code in accepted}
    return F.coalesce(looked_up(F.upper(stripped(c)), labels), F.lit(d.UNKNOWN))


def capital_flag(c: Column, pattern: str = d.CAPITAL_PATTERN) -> Column:
    """Capital if the name contains the pattern, in any case."""
    inside = F.contains(F.lower(c), F.lit(pattern.lower()))
    return F.when(inside, F.lit(d.CAPITAL)).otherwise(F.lit(d.INTERIOR))


def month_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_name(month: Column, names: Sequence[str] = d.MONTH_NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), month)


def season(
    month: Column, seasons: Mapping[str, Sequence[int]] = d.SEASONS, last: str = d.LAST_SEASON
) -> Column:
    """Southern-hemisphere season of a calendar month."""
    result = None
    for label, months in seasons.items():
        inside = month.isin(*months)
        result = F.when(inside, F.lit(label)) if result is None else result.when(inside, F.lit(label))
    return result.otherwise(F.lit(last))


def age_key(age: Column) -> Column:
    """Age as a join key that is never null."""
    return F.coalesce(age, F.lit(d.UNKNOWN_AGE_KEY))


def processing_time() -> Column:
    """Start of the query as ISO text in UTC, the same on every row."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
