"""Sums and ratios that give the same answer for any partitioning.

Adding doubles depends on the order of the rows, which changes from run to run
on a cluster. Amounts are added as decimals with six places and rounded once,
after the sum. An amount or a sum beyond 22 or 32 digits before the point
raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 6
AMOUNT = f"decimal(28,{PLACES})"


def amount(value: Column) -> Column:
    """An amount to six places; NULL for NaN and infinity, an error when out of range."""
    finite = F.when(~F.isnan(value.cast("double")) & (F.abs(value.cast("double")) < float("inf")), value)
    exact = finite.try_cast(AMOUNT)
    return F.when(finite.isNotNull() & exact.isNull(), F.raise_error(F.lit("amount out of range")).cast(AMOUNT)).otherwise(exact)


def total(value: Column) -> Column:
    """Exact sum, not rounded."""
    return F.sum(amount(value))


def as_money(exact: Column) -> Column:
    """An exact sum rounded to cents, half away from zero."""
    return F.round(exact, 2)


def money_sum(value: Column) -> Column:
    """Exact sum of money, rounded to cents."""
    return as_money(total(value))


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """``top / bottom`` rounded half away from zero; NULL for a zero or NULL bottom."""
    parts = top.cast("decimal(30,6)") / F.nullif(bottom, F.lit(0)).cast("decimal(19,0)")
    return F.round(parts, digits).cast("double")
