"""Top-k by an expression with a tie-breaking key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

_ROW_BITS = 33  # of monotonically_increasing_id(), below the number of the task


def top_k(df: DataFrame, by: Column, k: int | None, *ties: str) -> DataFrame:
    """First ``k`` rows by ``by``, then by the tie columns; all rows, sorted, when ``k`` is None.

    With ``k`` every task keeps only its own ``k`` best (TakeOrderedAndProject); nothing is shuffled.
    Without it the tie columns also let the range partitioner split runs of equal values.
    """
    ordered = df.orderBy(by, *[F.col(t).asc_nulls_last() for t in ties])
    return ordered if k is None else ordered.limit(k)


def with_position(ordered: DataFrame) -> DataFrame:
    """Add each row's place, from 1, in a sorted DataFrame.

    Tasks number their own rows; a running sum over one row per task gives where each begins.
    """
    numbered = stored(ordered.withColumn("_id", F.monotonically_increasing_id()), "positions")
    task = F.shiftright("_id", _ROW_BITS)
    sizes = numbered.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("_task", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_begin"))
    place = F.col("_begin") + F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return numbered.withColumn("_task", task).join(begins, "_task").withColumn("position", place).drop("_id", "_task", "_begin")
