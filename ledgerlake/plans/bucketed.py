"""Facts in buckets by customer, so that joins and groupings by customer do not shuffle them.

The facts are published in buckets by key and salt.  The salt is 0, but for keys that own more rows than a
task should read: theirs are spread over as many salts, and so buckets, as ``operators.skew`` says; rows
without a key are spread over all buckets.  The heavy keys are published beside the facts.  A join copies
the other side's rows of heavy keys once per salt and shuffles that side alone; a grouping by key and salt
needs no shuffle, and what is left is a row for each key and salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.gold import loans_per_customer
from ..operators.skew import SALT, TASK_ROWS, copy_per_salt, heavy_keys, salt_rows
from ..operators.topk import top_k
from ..session import stored
from ..sinks.publish import Buckets, PublishResult, publish
from .partials import customer_parts, merged_customers

HEAVY = "_heavy"


def publish_bucketed(
    df: DataFrame, table: str, key: str, *, buckets: int, spread_by: Sequence[str], task_rows: int = TASK_ROWS, **publishing
) -> PublishResult:
    """Publish facts in ``buckets`` by ``key`` and salt, and their heavy keys as ``<table>_heavy``.

    ``spread_by`` are the columns whose hash spreads a heavy key's rows.  The heavy keys go first, so that a
    reader never meets salts that it does not know of.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    counts = stored(counts, "key-counts")
    heavy = stored(heavy_keys(counts, key, "_rows", counts.agg(F.sum("_rows")).scalar(), task_rows), "heavy-keys")
    publish(heavy, f"{table}{HEAVY}")
    anywhere = F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("bigint")
    salted = salt_rows(df, heavy, key, list(spread_by)).withColumn(SALT, F.when(F.col(key).isNull(), anywhere).otherwise(F.col(SALT)))
    return publish(salted.select(*df.columns, SALT), table, bucket_by=Buckets(buckets, (key, SALT)), **publishing)


def join_bucketed(spark: SparkSession, facts: DataFrame, table: str, rows: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Facts of a bucketed table, filtered at will, joined with rows that have one per key."""
    return facts.join(copy_per_salt(rows, spark.table(f"{table}{HEAVY}"), key), [key, SALT], how).drop(SALT)


def flagged_detail(spark: SparkSession, table: str, customers: DataFrame) -> DataFrame:
    """``aml.flagged_detail`` over bucketed transactions."""
    flagged = spark.table(table).filter("is_flagged").select("txn_id", "customer_id", SALT, "amount", "channel", "narration", "txn_date")
    who = customers.select("customer_id", F.col("name").alias("customer_name"), "risk_category", "kyc_status")
    joined = join_bucketed(spark, flagged, table, who, "customer_id").select(
        "txn_id", "customer_id", "customer_name", "risk_category", "kyc_status", "amount", "channel", "narration", "txn_date"
    )
    return top_k(joined, F.col("amount").desc_nulls_last(), None, "txn_id")


def customer_360(spark: SparkSession, table: str, customers: DataFrame, loans: DataFrame, worst_by: str = "severity") -> DataFrame:
    """``gold.customer_360`` over bucketed transactions: they are added up where they lie."""
    parts = customer_parts(spark.table(table), SALT)
    return (
        customers.select("customer_id", "name", "risk_category", "kyc_status", "branch_code")
        .join(merged_customers(parts), "customer_id", "left")
        .join(loans_per_customer(loans, worst_by), "customer_id", "left")
    )
