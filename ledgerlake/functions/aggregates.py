"""Aggregate expressions with exact two-digit rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conditional_count(condition: Column) -> Column:
    """Rows meeting a condition; NULL (not 0) over no rows, as a SUM of CASE is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def rounded_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``numerator / denominator`` rounded half up once, NULL when the denominator is 0."""
    return F.round(F.try_divide(numerator, denominator), scale).cast(f"decimal(18,{scale})")


def money_avg(c: Column | str, scale: int = 2) -> Column:
    """Average of a decimal column rounded half up once.

    ``round(avg(x), 2)`` would round twice, since ``avg`` of a decimal(18,2) is already cut to six
    digits; the exact sum divided by the count keeps twelve.
    """
    c = _col(c)
    return rounded_ratio(F.sum(c), F.count(c).cast("decimal(20,0)"), scale)


def percent_of(part: Column, total: Column) -> Column:
    """Share in percent with two digits, computed on decimals so that ties round up."""
    as_decimal = "decimal(20,0)"
    return rounded_ratio(part.cast(as_decimal) * F.lit(100).cast("decimal(3,0)"), total.cast(as_decimal))
