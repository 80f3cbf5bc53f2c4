"""Rounding, guarded ratios and encodings as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SETTLE_DIGITS = 6


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_he(c: Column | str, digits: int) -> Column:
    """Round half to even on ``x * 10**digits``, in doubles."""
    power = float(10**digits)
    return F.rint(as_column(c).cast("double") * power) / power


def settle(c: Column | str, digits: int) -> Column:
    """Round to six digits, then to ``digits``.

    Sums of doubles depend on the order of the rows, which a shuffle does not
    fix. The first rounding drops that noise, so ties fall the same way on
    every run.
    """
    return round_he(round_he(c, SETTLE_DIGITS), digits)


def mean(c: Column | str, digits: int) -> Column:
    """Rounded average of a group."""
    return settle(F.avg(as_column(c).cast("double")), digits)


def total(c: Column | str, digits: int | None = None) -> Column:
    """Sum of a group; rounded when it adds doubles."""
    summed = F.sum(as_column(c))
    return summed if digits is None else settle(summed, digits)


def rate(num: Column | str, den: Column | str, digits: int, scale: float = 1.0) -> Column:
    """``scale * num / den`` rounded; NULL when the denominator is 0 or NULL."""
    top = F.lit(float(scale)) * as_column(num).cast("double")
    return settle(F.try_divide(top, as_column(den).cast("double")), digits)


def share(predicate: Column, digits: int = 1, of: Column | str | None = None) -> Column:
    """Percentage of the rows of a group that satisfy ``predicate``.

    With ``of`` only rows where that column is known are rows.
    """
    return rate(F.count_if(predicate), F.count(F.lit(1) if of is None else of), digits, 100.0)


def cyclic(c: Column | str, period: int, digits: int = 6) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = F.lit(2.0 * math.pi) * as_column(c) / F.lit(float(period))
    return round_he(F.sin(angle), digits), round_he(F.cos(angle), digits)


def clip(c: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest(as_column(c), F.lit(float(low))), F.lit(float(high)))


def period_key(year: Column | str, month: Column | str) -> Column:
    """``year * 100 + month`` in 32 bits."""
    return as_column(year).cast("int") * 100 + as_column(month).cast("int")
