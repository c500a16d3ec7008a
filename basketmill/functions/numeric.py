"""Rounding and ratios with one rule everywhere: round half up, through decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double on its decimal value, so that x.xx5 goes up whatever its binary form is."""
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def money(amount: Column) -> Column:
    """Decimal amount as a double with two decimals."""
    return F.round(amount, 2).cast("double")


def ratio(part: Column, total: Column) -> Column:
    """part / total as a double; NULL when the total is 0."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def percent(part: Column, total: Column, digits: int) -> Column:
    """part as a percentage of total (0-100 scale); NULL when the total is 0."""
    return round_half_up(F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double")), digits)


def percent_or_zero(part: Column, total: Column, digits: int = 2) -> Column:
    """Like `percent`, but 0 when the total is 0."""
    return F.coalesce(percent(part, total, digits), F.lit(0.0))
