"""Text clean-up and masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What counts as white space around a value: spaces, tabs and line ends.
WHITE_SPACE = " \t\n\x0b\f\r"


def stripped(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and white-space-only text."""
    c = _col(c)
    return c.isNull() | (F.length(stripped(c)) == 0)


def blank_to_null(c: Column | str) -> Column:
    """The comparison settles nearly all text: what starts behind the space is not blank, and trimming costs far more."""
    c = _col(c)
    return F.when((c >= "!") | (F.length(stripped(c)) > 0), c)


def normalised(c: Column | str) -> Column:
    return F.upper(stripped(c))


def mask_pan(c: Column | str) -> Column:
    """Hide the first five characters of a tax number."""
    return F.concat(F.lit("XXXXX"), F.substring(_col(c), 6, 5))


def mask_mobile(c: Column | str) -> Column:
    """Hide the first six digits of a mobile number."""
    return F.concat(F.lit("XXXXXX"), F.substring(_col(c), 7, 4))


def mask_email(c: Column | str) -> Column:
    """Keep only the domain; text without ``@`` is hidden whole, NULL stays NULL."""
    c = _col(c)
    domain = F.concat(F.lit("***@"), F.substring_index(c, "@", -1))
    return F.when(c.contains("@"), domain).when(c.isNotNull(), F.lit("***"))
