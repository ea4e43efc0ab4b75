"""Intermediate tables in the shared folder named by spark.checkpoint.dir."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir


FILE_ROWS = 50_000


def written(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """The rows as a table that was written and is read again: lineage ends there, and lost executors cost nothing.

    Where the caller knows a bound of their number, there are no more files than it needs.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{purpose}")
    schema = df.schema
    (df if rows is None else df.coalesce(bucket_count(rows, FILE_ROWS, 1))).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucket_count(n_rows: int, per_bucket: int = 20_000, least: int = 64) -> int:
    """How many buckets give about ``per_bucket`` rows each."""
    return max(least, -(-n_rows // per_bucket))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this library to the executors, once for each application, so that they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    top = pathlib.Path(__file__).resolve().parents[2]
    archive = pathlib.Path(tempfile.mkdtemp(prefix="ledgerlake-code-")) / "ledgerlake.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted((top / "ledgerlake").rglob("*.py")):
            out.write(file, file.relative_to(top))
    context.addPyFile(str(archive))
