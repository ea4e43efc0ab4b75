"""Gold from mergeable parts: measures by month that are added up, so that a refresh reads the months that changed.

A parts table is partitioned by month.  Counts and sums add, maxima are compared again, and customers are
counted from rows of their own, one per customer and month.  Refreshing a month replaces its partition and
nothing else; merging reads one row per customer and month, not the transactions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.aggregates import conditional_count
from ..operators.gold import loans_per_customer, transactions_per_customer

MONTH = "txn_month"


def customer_parts(transactions: DataFrame, *by: str) -> DataFrame:
    """What a customer's transactions add up to, per ``by``; the names of ``transactions_per_customer``."""
    return transactions.groupBy("customer_id", *by).agg(
        F.count("*").alias("total_txns"), F.sum("amount").alias("total_txn_amount"),
        F.max("txn_date").alias("last_txn_date"), conditional_count(F.col("is_flagged")).alias("flagged_txns"),
    )


def merged_customers(parts: DataFrame) -> DataFrame:
    """One row per customer, with the types of ``transactions_per_customer``."""
    amount = parts.schema["total_txn_amount"].dataType
    return parts.groupBy("customer_id").agg(
        F.sum("total_txns").alias("total_txns"), F.sum("total_txn_amount").cast(amount).alias("total_txn_amount"),
        F.max("last_txn_date").alias("last_txn_date"), F.sum("flagged_txns").alias("flagged_txns"),
    )


def customer_360_of(customers: DataFrame, parts: DataFrame, loans: DataFrame, worst_by: str = "severity") -> DataFrame:
    """``customer_360`` with the transactions' measures merged from parts."""
    return (
        customers.select("customer_id", "name", "risk_category", "kyc_status", "branch_code")
        .join(merged_customers(parts), "customer_id", "left")
        .join(loans_per_customer(loans, worst_by), "customer_id", "left")
    )


def refresh_parts(parts: DataFrame, table: str, months: Sequence[str] | None = None) -> None:
    """Replace the months of a parts table: all, or only those named, of which the rows alone are computed.

    The table is created on first use.  A named month without rows has none afterwards.  ``parts`` must
    come from silver and not from the table.
    """
    spark = parts.sparkSession
    order = [*[c for c in parts.columns if c != MONTH], MONTH]
    if not spark.catalog.tableExists(table):
        types = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
        spark.sql(f"CREATE TABLE {table} ({', '.join(f'`{c}` {types[c]}' for c in order)}) USING parquet PARTITIONED BY (`{MONTH}`)")
    if months is None:
        parts.select(*order).hint("rebalance", F.col(MONTH)).write.insertInto(table, overwrite=True)
    else:
        rest = ", ".join(f"`{c}`" for c in order[:-1])
        for month in dict.fromkeys(months):
            spark.sql(  # one partition, whole; one without rows becomes empty
                f"INSERT OVERWRITE TABLE {table} PARTITION (`{MONTH}` = :month) SELECT {rest} FROM {{parts}} WHERE `{MONTH}` = :month",
                args={"month": month}, parts=parts,
            )
    spark.catalog.refreshTable(table)


def refresh_customer_parts(spark: SparkSession, transactions: DataFrame, table: str, months: Sequence[str] | None = None) -> DataFrame:
    """Refresh the parts of customers by month and return the merged rows, as of ``transactions_per_customer``."""
    refresh_parts(customer_parts(transactions, MONTH), table, months)
    return merged_customers(spark.table(table)).select(*transactions_per_customer(transactions).columns)
