"""Exact money sums, guarded ratios and fixed-width bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Amount in whole cents. Integer sums do not depend on the order rows arrive in."""
    return F.round(amount.cast("double") * 100).try_cast("bigint")


def money_sum(amount: Column, where: Column | None = None) -> Column:
    """Exact sum of an amount, over the rows that satisfy ``where``; null over no rows."""
    value = cents(amount)
    return F.sum(value if where is None else F.when(where, value)) / F.lit(100.0)


def money_sum_or_zero(amount: Column, where: Column | None = None) -> Column:
    return F.coalesce(money_sum(amount, where), F.lit(0.0))


def money_avg(amount: Column, where: Column | None = None) -> Column:
    value = cents(amount)
    chosen = value if where is None else F.when(where, value)
    return F.try_divide(F.sum(chosen) / F.lit(100.0), F.count(chosen).cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * part.cast("double"), whole), digits)


def fixed_bin(value: Column, low: float, width: float, bins: int) -> Column:
    """Index of the equal-width bin; values outside the range fall into the end bins."""
    index = F.floor((value.cast("double") - F.lit(float(low))) / F.lit(float(width)))
    return F.least(F.greatest(index, F.lit(0)), F.lit(bins - 1)).cast("bigint")
