"""Casts that turn unparseable text into NULL instead of failing the job (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_money(c: Column | str) -> Column:
    return to_decimal(c, 18, 2)


def strict_int(c: Column | str) -> Column:
    """Whole numbers only: ``'12.7'`` is NULL.  Used by the raw reports.

    The pattern goes first because ``try_cast`` to int raises and catches an exception for every text
    that is no number, which costs many times the test.
    """
    c = _col(c)
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("int"))


def to_int(c: Column | str) -> Column:
    """Whole part of a number: ``'12.7'`` is 12, ``'abc'`` is NULL.  Used by the silver layer."""
    return _col(c).try_cast("decimal(30,10)").try_cast("int")


def to_timestamp(c: Column | str) -> Column:
    """Accepts ``2026-04-14 09:15:30`` and ``2026-04-14T09:15:30``."""
    return F.try_to_timestamp(_col(c))


def cast_as(c: Column | str, type_name: str) -> Column:
    """Tolerant cast by type name, as listed in an entity's ``casts``."""
    if type_name == "int":
        return to_int(c)
    if type_name == "timestamp":
        return to_timestamp(c)
    return _col(c).try_cast(type_name)
