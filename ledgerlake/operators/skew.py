"""Joins on keys of which a few own much of the data.

AQE splits a skewed partition only when both join inputs come straight out of a shuffle and nothing
above relies on the join's partitioning.  Where one input is itself an aggregate or a join, the heavy
keys are salted by hand: their rows are spread over salts, as many as their number of rows needs, and the
other side's row is copied once per salt.  All other keys have the salt 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SALT = "_salt"
TASK_ROWS, TASKS = 1_000_000, 100_000


def heavy_keys(counts: DataFrame, key: str, rows: str, total: Column, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more rows than a task should hold, and how many salts cut them to that size.

    A task should hold ``task_rows`` rows, or the hundred-thousandth part of all rows if that is more.
    So no salted or unsalted key gives a task more than that, and there are at most 100,000 heavy keys,
    whatever the data: their list may be broadcast.
    """
    limit = F.greatest(F.lit(float(task_rows)), total / TASKS)
    return counts.filter(F.col(rows) > limit).select(key, F.ceil(F.col(rows) / limit).alias("_salts"))


def salt_rows(rows: DataFrame, heavy: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Add a salt to the many-rows side: 0, or for heavy keys a hash of the ``spread_by`` columns."""
    marked = rows.join(F.broadcast(heavy), key, "left")
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_salts")), F.lit(0))
    return marked.withColumn(SALT, salt.cast("bigint")).drop("_salts")


def copy_per_salt(keys: DataFrame, heavy: DataFrame, key: str) -> DataFrame:
    """Copy the other side's rows of heavy keys, one for each salt."""
    marked = keys.join(F.broadcast(heavy), key, "left")
    last = F.coalesce(F.col("_salts"), F.lit(1)).cast("bigint") - 1
    return marked.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("_salts")
