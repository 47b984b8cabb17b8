"""Sums, rounding and display of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Amounts below this have their minor units in 18 decimal digits.
EXACT_BELOW = 1e14


def money_sum(amount: str | Column, minor_units: int | None = None) -> Column:
    """Sum of a DOUBLE amount; NULL when there is no amount at all.

    Adding doubles gives last-digit differences that depend on the order of addition, and so on
    the partitioning. With ``minor_units`` (100 for cents) whole minor units are added instead, as
    decimals: exactly, whatever the number of rows, the order and the partitioning, and after any
    retry. The result becomes a DOUBLE once, at the end. Amounts finer than the minor unit are rounded to it.

    Absurd amounts (of 1e14 and more, infinite, or not a number) do not fit; they are added as doubles and
    then to the exact sum, so that none is left out and none stops the job.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    if minor_units is None:
        return F.sum(column)
    fits = F.abs(column) < EXACT_BELOW
    units = F.when(fits, F.rint(column * F.lit(float(minor_units)))).cast("decimal(18,0)")
    exact = F.sum(units).cast("double") / F.lit(float(minor_units))
    rest = F.sum(F.when(~fits, column))
    return F.coalesce(exact + rest, exact, rest)


def round_half_even(value: str | Column, digits: int = 2) -> Column:
    """Round the way numpy does: scale, go to the nearest integer (ties to even), scale back."""
    column = F.col(value) if isinstance(value, str) else value
    scale = F.lit(float(10**digits))
    return F.rint(column * scale) / scale


def as_count(value: str) -> Column:
    """1234567 -> ``1,234,567``"""
    return F.format_number(F.col(value), 0)


def as_dollars(value: str, digits: int) -> Column:
    """1234.5 -> ``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(F.col(value), digits))


def as_percent(value: str) -> Column:
    """6.07 -> ``6.1%``; ties go to the even digit."""
    return F.concat(F.format_number(F.col(value), 1), F.lit("%"))
