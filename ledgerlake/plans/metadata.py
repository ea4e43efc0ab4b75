"""How a file-backed table is laid out: per partition and per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def partition_profile(table: DataFrame, *partition_columns: str) -> DataFrame:
    """Rows and files per partition."""
    return table.groupBy(*partition_columns).agg(
        F.count("*").alias("row_count"),
        F.count_distinct(F.col("_metadata.file_path")).alias("file_count"),
    )


def file_profile(table: DataFrame) -> DataFrame:
    """Rows and bytes of every file."""
    return table.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes")
    ).agg(F.count("*").alias("row_count"))


def range_profile(table: DataFrame, *columns: str) -> DataFrame:
    """Rows of every file, and the least and greatest value of some columns there (``min_<c>``, ``max_<c>``).

    A filter on such a column reads the files whose range it meets: see ``files_met``.
    """
    ends = [f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "min"), (F.max, "max"))]
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("row_count"), *ends)


def files_met(profile: DataFrame, **ranges: tuple) -> DataFrame:
    """How many files and rows of a ``range_profile`` a filter must read, of how many.

    A range is (least, greatest) wanted of a column, either of them None where it is open.
    """
    met = F.lit(True)
    for column, (least, greatest) in ranges.items():
        if least is not None:
            met = met & (F.col(f"max_{column}") >= F.lit(least))
        if greatest is not None:
            met = met & (F.col(f"min_{column}") <= F.lit(greatest))
    return profile.agg(
        F.count_if(met).alias("files_met"), F.count("*").alias("files"),
        F.coalesce(F.sum(F.when(met, F.col("row_count"))), F.lit(0)).alias("rows_met"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
    )
