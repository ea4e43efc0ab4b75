"""Tables: append, full refresh, and refreshes that readers see at once.

A published table ``db.t`` is a view on the table of its latest run, ``db.t__<run_id>``.  A run creates its own
table, marked as such, and fills it; then the view is switched in one catalog call, so readers never see a half-written
refresh and a failed run leaves the previous one in place; then the run is logged.  The table of the
run before stays for readers that are still in it; older ones are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .contract import conforming
from .curve import Curve, along_curve

LOG_TABLE = "_publish_log"
# Marks the table of a single run with the name it was published under.
RUN_PROPERTY = "ledgerlake.run_of"


@dataclass(frozen=True)
class PublishResult:
    table: str
    run_id: str
    rows: int

    @property
    def run_table(self) -> str:
        """The table that holds this run."""
        return f"{self.table}__{self.run_id}"


@dataclass(frozen=True)
class Buckets:
    """Rows with equal ``columns`` lie in one of ``number`` files' worth of buckets, sorted by them."""

    number: int
    columns: tuple[str, ...]


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one table partition together before a partitioned write.

    ``rebalance`` lets AQE cut a big partition (a month holding a third of all rows) into several
    tasks and merge small ones, so files come out near the advisory size either way.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def files_of(spark: SparkSession, table: str) -> set[str]:
    spark.catalog.refreshTable(table)
    return set(spark.table(table).inputFiles())


def rows_in(spark: SparkSession, files: Iterable[str], fmt: str) -> int:
    """Rows of data files; of parquet only the footers are read, which say how many rows a file has."""
    files = sorted(files)
    if not files:
        return 0
    reader = spark.read.format(fmt) if fmt == "parquet" else spark.read.format(fmt).schema("_unread string")
    return reader.load(files).count()


def _write(df: DataFrame, table: str, mode: str, partition_by: Sequence[str], fmt: str) -> int:
    """Rows written, counted in the files that the write has left; what a repeated task counts makes no difference."""
    spark = df.sparkSession
    before = files_of(spark, table) if mode == "append" and spark.catalog.tableExists(table) else set()
    writer = laid_out(df, partition_by).write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return rows_in(spark, files_of(spark, table) - before, fmt)


def append(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet", contract: T.StructType | None = None
) -> int:
    """Append to a table, creating it on first use; returns the rows written.  ``contract`` gates the write."""
    return _write(conforming(df, contract, table) if contract else df, table, "append", partition_by, fmt)


def replace(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet", contract: T.StructType | None = None
) -> int:
    """Plain full refresh; atomic only where the table format makes it so."""
    return _write(conforming(df, contract, table) if contract else df, table, "overwrite", partition_by, fmt)


def new_run_id() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"


def run_of(spark: SparkSession, table: str) -> str | None:
    """The published name whose run a table holds; None for all other tables."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == RUN_PROPERTY).first()
    return found["value"] if found else None


def _create_run_table(df: DataFrame, table: str, short: str, partition_by: Sequence[str], fmt: str, bucket_by: Buckets | None) -> list[str]:
    """An empty table that already says whose run it holds; returns its columns in order."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    order = [c for c in fields if c not in partition_by] + list(partition_by)
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    parts = [f"CREATE TABLE {table} ({', '.join(f'`{c}` {fields[c]}' for c in order)}) USING {fmt}"]
    if fmt == "parquet":
        parts.append("OPTIONS (compression 'snappy')")
    if partition_by:
        parts.append(f"PARTITIONED BY ({quoted(partition_by)})")
    if bucket_by:
        parts.append(f"CLUSTERED BY ({quoted(bucket_by.columns)}) SORTED BY ({quoted(bucket_by.columns)}) INTO {bucket_by.number} BUCKETS")
    df.sparkSession.sql(" ".join([*parts, f"TBLPROPERTIES ('{RUN_PROPERTY}' = '{short}')"]))
    return order


def _logged(spark: SparkSession, namespace: str, short: str, run_id: str, rows: int, fmt: str) -> None:
    spark.range(1).select(
        F.lit(short).alias("table_name"), F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("published_at"), F.lit(rows).cast("bigint").alias("row_count"),
    ).write.mode("append").format(fmt).saveAsTable(f"{namespace}.{LOG_TABLE}")


def _recover(spark: SparkSession, namespace: str, short: str, before: str | None, fmt: str) -> None:
    """Complete the log where a publish stopped between switching its view and logging its run.

    Tables of runs that stopped earlier bear their mark and are dropped with the old ones.
    """
    if before is None:
        return
    run_id = before.rpartition(".")[2].removeprefix(f"{short}__")
    log = f"{namespace}.{LOG_TABLE}"
    if spark.catalog.tableExists(log):
        spark.catalog.refreshTable(log)
        if not spark.table(log).filter((F.col("table_name") == short) & (F.col("run_id") == run_id)).isEmpty():
            return
    _logged(spark, namespace, short, run_id, rows_in(spark, files_of(spark, before), fmt), fmt)


def publish(
    df: DataFrame,
    table: str,
    *,
    partition_by: Sequence[str] = (),
    run_id: str | None = None,
    fmt: str = "parquet",
    contract: T.StructType | None = None,
    bucket_by: Buckets | None = None,
    curve: Curve | None = None,
) -> PublishResult:
    """Write a new run of ``db.table``, make it the current one, and log it.

    The run's table is created with its mark before a row is written.  Wherever a publish stops, readers
    keep a whole run, checks do not take the rest for a user's table, and the next publish clears it away.
    ``contract`` refuses columns and types before anything is created; ``bucket_by`` stores the run in
    buckets, ``curve`` in files that are narrow in several columns.
    """
    if bucket_by and curve:
        raise ValueError("a table lies in buckets or along a curve, not both")
    spark = df.sparkSession
    namespace, _, short = table.rpartition(".")
    if not namespace:
        raise ValueError("table must be given as namespace.name")
    if contract:
        df = conforming(df, contract, table)
    before = None
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType != "VIEW":
            raise ValueError(f"{table} is a plain table; publish under another name or drop it first")
        before = spark.sql(f"SHOW TBLPROPERTIES {table} ('{RUN_PROPERTY}')").first()["value"]
    _recover(spark, namespace, short, before, fmt)
    result = PublishResult(table, run_id or new_run_id(), 0)
    order = _create_run_table(df, result.run_table, short, partition_by, fmt, bucket_by)
    if bucket_by:
        laid = df.repartition(bucket_by.number, *bucket_by.columns)
    else:
        laid = along_curve(df, curve, partition_by) if curve else laid_out(df, partition_by)
    laid.select(*order).write.mode("append").insertInto(result.run_table)
    rows = rows_in(spark, files_of(spark, result.run_table), fmt)
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{RUN_PROPERTY}' = '{result.run_table}') "
        f"AS SELECT * FROM {result.run_table}"
    )
    _logged(spark, namespace, short, result.run_id, rows, fmt)
    for name in (t.name for t in spark.catalog.listTables(namespace, f"{short}__*") if not t.isTemporary):
        full = f"{namespace}.{name}"
        if full not in (result.run_table, before) and run_of(spark, full) == short:
            spark.sql(f"DROP TABLE {full}")
    return PublishResult(table, result.run_id, rows)
