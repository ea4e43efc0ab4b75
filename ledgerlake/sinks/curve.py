"""Layout along a space-filling curve, so that a filter on any of several columns leaves out most files.

Every column becomes a rank among its quantiles, and the bits of the ranks are interleaved.  Rows near each
other in that order are near each other in every column, so the least and greatest values that parquet
keeps of each file and row group are close together for all of them.  A plain sort does that for its
first column alone.
"""

from __future__ import annotations

import os.path
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

_TEXT_BYTES = 7  # of a text behind what all texts begin with; as a number they fit a long


@dataclass(frozen=True)
class Curve:
    """Columns to interleave by ``bits`` bits each, and how many files to make (by default as AQE sees fit).

    ``spread_by`` are the columns whose hash tells rows apart that are equal in all of ``columns``, so that
    very many of them do not end in one file; all columns, if not given.
    """

    columns: tuple[str, ...]
    bits: int = 8
    files: int | None = None
    spread_by: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.columns or self.bits % 2 or not 0 < self.bits * len(self.columns) < 64:
            raise ValueError("a curve needs columns, an even number of bits for each, and fewer than 64 bits in all")


def _number(column: Column, kind: T.DataType, skip: int) -> Column:
    """A number that orders as the column does; of texts the bytes behind the first ``skip``."""
    if isinstance(kind, T.StringType):
        digits = F.hex(F.substring(column.cast("binary"), skip + 1, _TEXT_BYTES))
        return F.conv(F.rpad(digits, 2 * _TEXT_BYTES, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    if isinstance(kind, T.NumericType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    raise ValueError(f"a curve cannot order {kind.simpleString()}")


def _common(least: str | None, greatest: str | None) -> int:
    """How many bytes all texts between the least and the greatest begin with."""
    return len(os.path.commonprefix([(least or "").encode(), (greatest or "").encode()]))


def _rank(number: Column, splitters: list, bits: int) -> Column:
    """How many of the sorted splitters are not greater, found in two steps of about the square root of their number."""
    if not splitters:
        return F.lit(0).cast("bigint")
    width = 1 << (bits // 2)
    every = F.array(*map(F.lit, splitters))
    coarse = F.array(*map(F.lit, splitters[width - 1 :: width])) if len(splitters) >= width else F.slice(every, 1, 0)
    far = lambda known: F.size(F.filter(known, lambda s: s <= number))
    rank = F.transform(F.array(far(coarse)), lambda c: c * width + far(F.slice(every, c * width + 1, F.lit(width - 1))))[0]
    return F.coalesce(F.when(number.isNotNull(), rank), F.lit(0)).cast("bigint")


def _interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number of the bits of all ranks, the highest first."""
    n = len(ranks)

    def woven(held: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for bit in range(bits):
            for j in range(n):
                one = F.shiftright(held[j], bit).bitwiseAND(F.lit(1).cast("bigint"))
                out = out.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - j))
        return out

    return F.transform(F.array(F.array(*ranks)), woven)[0]


def position(df: DataFrame, curve: Curve) -> Column:
    """The place of each row of ``df`` on the curve.  Null and not-a-number rank lowest.

    Two passes over the curve's columns find what texts begin with and the quantiles; at most
    ``2**bits`` of these for each column come to the driver.
    """
    kinds = {c: df.schema[c].dataType for c in curve.columns}
    texts = [c for c in curve.columns if isinstance(kinds[c], T.StringType)]
    ends = df.agg(*(f(F.col(c)) for c in texts for f in (F.min, F.max))).first() if texts else []
    skip = {c: _common(*ends[2 * i : 2 * i + 2]) for i, c in enumerate(texts)}
    numbers = [_number(F.col(c), kinds[c], skip.get(c, 0)) for c in curve.columns]
    steps = 1 << curve.bits
    found = df.agg(*(F.percentile_approx(x, [i / steps for i in range(1, steps)], 16 * steps) for x in numbers)).first()
    return _interleaved([_rank(x, sorted(f or []), curve.bits) for x, f in zip(numbers, found, strict=True)], curve.bits)


def along_curve(df: DataFrame, curve: Curve, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` in ranges of (partition columns, place on the curve), sorted within each."""
    place = "_place"
    while place in df.columns:
        place += "_"
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.xxhash64(*(curve.spread_by or plain))
    keys = [*map(F.col, partition_by), F.col(place)]
    placed = df.withColumn(place, position(df, curve))
    ranged = placed.repartitionByRange(*([curve.files] if curve.files else []), *keys, spread)
    return ranged.sortWithinPartitions(*keys).drop(place)
