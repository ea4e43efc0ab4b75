"""Checks on layers: required tables, counts, reconciliation, column contracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sinks.publish import LOG_TABLE, run_of
from ..sources.offset_index import INDEX_SUFFIX, is_index
from ..specs import SPECS
from .fingerprints import compared_fingerprints, key_fingerprints


def required_tables(spark: SparkSession, namespace: str = "bronze") -> DataFrame:
    """Whether each required bronze table exists and has rows (an empty one is only a warning)."""
    checks = []
    for spec in SPECS.values():
        if not spec.required:
            continue
        name = f"{namespace}.{spec.bronze_table}"
        present = spark.catalog.tableExists(name)
        probe = spark.table(name).limit(1) if present else spark.range(0)
        checks.append(probe.agg((F.count("*") > 0).alias("has_rows")).select(
            F.lit(name).alias("table_name"), F.lit(present).alias("present"), "has_rows"
        ))
    return reduce(DataFrame.unionByName, checks)


def run_of_published(spark: SparkSession, namespace: str, name: str) -> str | None:
    """The published name whose run a table holds, decided by its property alone; views hold no run."""
    full = f"{namespace}.`{name}`"
    return None if spark.catalog.getTable(f"{namespace}.{name}").tableType == "VIEW" else run_of(spark, full)


def layer_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Tables a user sees in a namespace: not the log, not the tables of single runs, not the indexes of offsets."""
    if not spark.catalog.databaseExists(namespace):
        return []
    names = [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]
    own = [n for n in names if n != LOG_TABLE and run_of_published(spark, namespace, n) is None]
    return sorted(n for n in own if not n.endswith(INDEX_SUFFIX) or not is_index(spark, f"{namespace}.`{n}`"))


def layer_counts(spark: SparkSession, namespaces: Iterable[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Row count of every table of every layer."""
    counts = [
        spark.table(f"{layer}.{name}").agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer in namespaces
        for name in layer_tables(spark, layer)
    ]
    if not counts:
        return spark.createDataFrame([], "layer string, table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, counts).orderBy("layer", "table_name")


def reconciliation(layers: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Per entity: bronze rows, distinct bronze keys, silver rows, and whether silver has just those keys, one row each.

    Bronze may hold repeats, so its plain row count need not match.  Keys are compared by fingerprints of
    buckets; ``fingerprints.key_differences`` names those that differ.
    """
    parts = []
    for name, (bronze, silver, key) in layers.items():
        compared = compared_fingerprints(key_fingerprints(bronze, key), key_fingerprints(silver, key))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias
        parts.append(
            compared.agg(
                total("left_rows")("bronze_rows"), total("left_keys")("bronze_keys"), total("right_rows")("silver_rows"),
                F.coalesce(F.bool_and("agree"), F.lit(True)).alias("same_keys"),
            ).select(
                F.lit(name).alias("entity"), "bronze_rows", "bronze_keys", "silver_rows",
                (F.col("same_keys") & (F.col("bronze_keys") == F.col("silver_rows"))).alias("matches"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def contract_differences(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Every column of a table or of its contract: column_name, expected_type, found_type, agrees."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = [*wanted, *[n for n in found if n not in wanted]]
    return df.sparkSession.createDataFrame(
        [(n, wanted.get(n), found.get(n), wanted.get(n) == found.get(n)) for n in names],
        "column_name string, expected_type string, found_type string, agrees boolean",
    )


def layer_columns(spark: SparkSession, namespace: str, contracts: Mapping[str, T.StructType]) -> DataFrame:
    """The columns of all tables of a namespace against their contracts; a table without one agrees."""
    parts = []
    for name in layer_tables(spark, namespace):
        table = spark.table(f"{namespace}.{name}")
        parts.append(contract_differences(table, contracts.get(name, table.schema)).select(
            F.lit(namespace).alias("layer"), F.lit(name).alias("table_name"), "*"
        ))
    if not parts:
        return spark.createDataFrame(
            [], "layer string, table_name string, column_name string, expected_type string, found_type string, agrees boolean"
        )
    return reduce(DataFrame.unionByName, parts)
