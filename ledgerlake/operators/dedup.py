"""One row per key, chosen repeatably."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

# Columns that say how recent a row is, most telling first; used where present.
RECENCY = ("_ingestion_ts", "kafka_timestamp", "kafka_partition", "kafka_offset")

BETWEEN, ESCAPE = "\0", "\1"  # below all other characters


def default_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Latest arrival first, then every remaining column, so that ties cannot change the result."""
    recency = [c for c in RECENCY if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in recency]
    return [F.col(c).desc_nulls_last() for c in [*recency, *rest]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key by ``order``; rows with a NULL key are dropped.

    ``row_number() = 1`` lets Spark cut every key to one row inside each task before the shuffle
    (WindowGroupLimit), so a key repeated in a third of all rows sends one row per task.  Rows are
    sorted by a hash of the key first: ids mostly share their first eight characters, which is all
    that Spark's sort compares cheaply, and whole-row comparisons would dominate.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order) if order is not None else default_order(df, keys)
    present = [F.col(k).isNotNull() for k in keys]
    not_null = df.filter(reduce(and_, present))
    if not order:
        return not_null.dropDuplicates(keys)
    hashed = not_null.withColumn("_hash", F.xxhash64(*keys))
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return hashed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank", "_hash")


def as_one_text(columns: Sequence[str]) -> Column:
    """Text columns, NULL or not empty, as one text that sorts as they do in turn, NULL below all text."""
    given = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    whole = F.concat_ws("", *columns)
    # Only these two characters inside a value need another spelling, which keeps their order.
    spelled = F.transform(F.array(*given), lambda c: F.replace(
        F.replace(c, F.lit(ESCAPE), F.lit(ESCAPE + "\2")), F.lit(BETWEEN), F.lit(ESCAPE * 2)
    ))
    rare = whole.contains(BETWEEN) | whole.contains(ESCAPE)
    return F.when(rare, F.array_join(spelled, BETWEEN)).otherwise(F.concat_ws(BETWEEN, *given))


def texts_of(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """The columns that ``as_one_text`` joined, in place of that text."""
    one = F.col(text)

    def value(n: Column) -> Column:
        cut = F.call_function("substring_index", F.call_function("substring_index", one, F.lit(BETWEEN), n), F.lit(BETWEEN), F.lit(-1))
        return F.replace(F.replace(cut, F.lit(ESCAPE * 2), F.lit(BETWEEN)), F.lit(ESCAPE + "\2"), F.lit(ESCAPE))

    # ``split`` goes through Java's strings, which would change bytes that are no UTF-8.
    plain = F.is_valid_utf8(one) & ~one.contains(ESCAPE)
    one_by_one = F.transform(F.sequence(F.lit(1), F.lit(len(columns))), value)
    parts = df.withColumn("_parts", F.when(plain, F.split(one, BETWEEN, -1)).otherwise(one_by_one))
    values = [F.nullif(F.get("_parts", F.lit(n)), F.lit("")).alias(c) for n, c in enumerate(columns)]
    return parts.select(*[c for c in df.columns if c != text], *values)
