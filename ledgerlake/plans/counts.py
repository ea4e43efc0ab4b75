"""Row counts and ingestion freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(
    tables: Mapping[str, DataFrame], name_column: str = "tbl", count_column: str = "rows"
) -> DataFrame:
    """One row per table with its row count; on Parquet a count reads only file footers."""
    counts = [
        df.agg(F.count("*").alias(count_column)).select(F.lit(name).alias(name_column), count_column)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(name_column)


def ingestion_freshness(bronze: DataFrame) -> DataFrame:
    """Oldest, newest and last ingested message per topic."""
    return bronze.groupBy("kafka_topic").agg(
        F.count("*").alias("messages"),
        F.min("kafka_timestamp").alias("oldest_msg"),
        F.max("kafka_timestamp").alias("newest_msg"),
        F.max("_ingestion_ts").alias("last_ingested"),
    )
