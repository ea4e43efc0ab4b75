"""Rows to keyed JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

# Row numbers inside one input partition take the low 33 bits of monotonically_increasing_id().
_ROW_BITS = (1 << 33) - 1


def to_envelopes(df: DataFrame, topic: str, key: str) -> DataFrame:
    """``key``, ``value`` (one JSON object, NULL fields kept) and ``topic`` for every row.

    Without the key column the key is ``row_<n>``, unique within the input.
    """
    if key in df.columns:
        key_column = F.col(key).cast("string")
    else:
        key_column = F.concat(F.lit("row_"), F.monotonically_increasing_id().cast("string"))
    return df.select(
        key_column.alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"),
    )


def preview(envelopes: DataFrame, rows: int = 3, chars: int = 200) -> DataFrame:
    """Dry run: the first messages, their values cut for display."""
    return envelopes.limit(rows).select("topic", "key", F.substring("value", 1, chars).alias("value"))


def _next_offset(spark: SparkSession, fmt: str, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return 0
    last = spark.read.schema("offset bigint").format(fmt).load(path).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def write_envelopes(
    envelopes: DataFrame,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Send to Kafka (which assigns partitions and offsets), or append envelope files.

    Files lie in a folder for each topic, so that a reader of one skips the others.  Partition and
    offset come from the input partition and the row's place in it, above
    all offsets already there; one writer per path at a time.
    """
    if fmt == "kafka":
        envelopes.write.format("kafka").options(**dict(options or {})).save()
        return
    start = _next_offset(envelopes.sparkSession, fmt, path)
    (
        envelopes.select(
            "key", "value", "topic",
            F.spark_partition_id().alias("partition"),
            (F.lit(start) + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))).alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        .write.mode("append").partitionBy("topic").format(fmt).options(**dict(options or {})).save(path)
    )
