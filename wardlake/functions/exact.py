"""Rounded ratios in integer arithmetic, the same on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, total: Column, decimals: int = 2) -> Column:
    """``100 * part / total`` rounded half up; null for an empty total.

    For counts: neither is negative. Long arithmetic holds up to 4.6e14 with two decimals,
    and raises (it does not wrap) beyond that under ANSI mode.
    """
    part, total = part.cast("long"), total.cast("long")
    scale = 10**decimals
    rounded = F.call_function("div", F.lit(200 * scale) * part + total, F.lit(2) * total)
    return F.when(total > 0, rounded / F.lit(float(scale)))


def half_up(value: Column, decimals: int) -> Column:
    """A non-negative value with few decimals rounded half up to fewer (2 to 1, say).

    Goes through a decimal so that 12.25 is a tie however the double is stored.
    """
    return F.round(value.cast("decimal(20,6)"), decimals).cast("double")


def mean3(score: Column) -> Column:
    """Mean of values with three decimals, rounded half away from zero to three decimals.

    Sums integer thousandths, so the result does not depend on the order of addition.
    """
    thousandths = F.sum(F.round(score.cast("double") * 1000).cast("long"))
    n = F.count(score)
    size = F.call_function("div", F.lit(2) * F.abs(thousandths) + n, F.lit(2) * n)
    return F.when(n > 0, F.signum(thousandths) * size / F.lit(1000.0) + F.lit(0.0))
