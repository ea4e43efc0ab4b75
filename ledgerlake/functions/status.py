"""Loan status lookups: severity rank and provision percentage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from ..rules import PROVISION_PCT, SEVERITY_ORDER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nth(position: Column, options: Sequence[str | Column]) -> Column:
    """The option at a 1-based position, NULL for NULL (``element_at`` in ANSI mode gives the last)."""
    chosen = F
    for number, option in enumerate(options, start=1):
        chosen = chosen.when(position == number, F.lit(option) if isinstance(option, str) else option)
    return chosen


def severity_rank(c: Column | str, order: Sequence[str] = SEVERITY_ORDER) -> Column:
    """1 for the mildest status; NULL for an unknown one, so that it sorts last."""
    c = _col(c)
    rank = F
    for position, status in enumerate(order, start=1):
        rank = rank.when(c == status, position)
    return rank


def worst_status(
    c: Column | str, by: str = "severity", order: Sequence[str] = SEVERITY_ORDER
) -> Column:
    """Most severe status of a group (aggregate); ``by="lexical"`` takes the largest text instead.

    Statuses outside ``order`` are passed over.  The aggregate is the largest rank, not the largest
    text: Spark can update numbers in place and so hashes the groups, while text makes it sort them.
    """
    c = _col(c)
    if by == "lexical":
        return F.max(c)
    if by != "severity":
        raise ValueError(f"by must be 'severity' or 'lexical', not {by!r}")
    return nth(F.max(severity_rank(c, order)), order)


def provision_pct(c: Column | str, table: Mapping[str, Decimal] = PROVISION_PCT) -> Column:
    """Provision percentage of a status, 0 for an unknown one."""
    c = _col(c)
    pct = F
    for status, value in table.items():
        pct = pct.when(c == status, F.lit(value).cast("decimal(5,2)"))
    return pct.otherwise(F.lit(Decimal("0.00")).cast("decimal(5,2)"))
