"""Transaction analytics, on raw bronze strings and on silver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.aggregates import conditional_count, money_avg, percent_of
from ..functions.casting import to_money, to_timestamp
from ..functions.text import is_blank, normalised
from ..operators.topk import top_k


# --- bronze: text columns, unparseable values left out or counted -------------------------------

def channel_distribution_raw(bronze: DataFrame) -> DataFrame:
    valid = bronze.select(
        normalised("channel").alias("channel"), to_money("amount").alias("amount"), "customer_id"
    ).filter(F.col("amount").isNotNull())
    return valid.groupBy("channel").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        money_avg("amount").alias("avg_amount"),
        F.count_distinct("customer_id").alias("unique_customers"),
    ).orderBy(F.col("total_amount").desc_nulls_last(), "channel")


def branch_type_top_raw(bronze: DataFrame, k: int = 15) -> DataFrame:
    valid = bronze.select(
        "branch_code", normalised("txn_type").alias("txn_type"), to_money("amount").alias("amount")
    ).filter(F.col("amount").isNotNull())
    grouped = valid.groupBy("branch_code", "txn_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.max("amount").alias("max_amount"),
    )
    return top_k(grouped, F.col("total_amount").desc_nulls_last(), k, "branch_code", "txn_type")


def hourly_pattern_raw(bronze: DataFrame) -> DataFrame:
    valid = bronze.select(
        F.hour(to_timestamp("txn_date")).alias("txn_hour"), to_money("amount").alias("amount")
    ).filter(F.col("txn_hour").isNotNull() & F.col("amount").isNotNull())
    return valid.groupBy("txn_hour").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    ).orderBy("txn_hour")


def data_quality(bronze: DataFrame, blank_is_missing: bool = True) -> DataFrame:
    """One row of counters.  A blank customer counts as missing unless told otherwise."""
    customer = F.col("customer_id")
    missing = is_blank(customer) if blank_is_missing else customer.isNull()
    return bronze.agg(
        F.count("*").alias("total_rows"),
        conditional_count(to_money("amount").isNull()).alias("bad_amount"),
        conditional_count(to_timestamp("txn_date").isNull()).alias("bad_txn_date"),
        conditional_count(missing).alias("missing_customer"),
    )


# --- silver ---------------------------------------------------------------------------------------

def branch_summary(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("branch_code", "txn_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        money_avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.count_distinct("customer_id").alias("unique_customers"),
    ).orderBy(F.col("total_amount").desc_nulls_last(), "branch_code", "txn_type")


def channel_share(transactions: DataFrame) -> DataFrame:
    """Count, total and share of all transactions per channel.

    The grand total is a scalar subquery counting the same table, so no unpartitioned window is
    needed; on a Parquet table it reads file footers only.
    """
    total = transactions.agg(F.count("*")).scalar()
    grouped = transactions.groupBy("channel").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    )
    return grouped.withColumn("pct_of_total", percent_of(F.col("txn_count"), total)).orderBy(
        F.col("txn_count").desc(), F.col("channel").asc_nulls_last()
    )


def hourly_pattern(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("txn_hour").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    ).orderBy(F.col("txn_hour").asc_nulls_last())


def in_month(transactions: DataFrame, month: str) -> Column:
    """Rows of one month (``yyyy-MM``).

    Two equivalent conditions: ``txn_month`` prunes the partitions of the published table, and the
    range on ``txn_date`` reaches the Parquet row-group statistics of an unpartitioned one.
    """
    year, number = (int(part) for part in month.split("-"))
    first = date(year, number, 1)
    after = date(year + number // 12, number % 12 + 1, 1)
    type_ = transactions.schema["txn_date"].dataType
    start, end = (F.lit(f"{d} 00:00:00").cast(type_) for d in (first, after))
    stamp = F.col("txn_date")
    return (F.col("txn_month") == month) & (stamp >= start) & (stamp < end)


def monthly_summary(transactions: DataFrame, month: str) -> DataFrame:
    return (
        transactions.filter(in_month(transactions, month))
        .groupBy("branch_code", "channel", "txn_type")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("amount").alias("total_amount"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .orderBy(F.col("total_amount").desc_nulls_last(), "branch_code", "channel", "txn_type")
    )


def month_total(transactions: DataFrame, month: str) -> DataFrame:
    return transactions.filter(in_month(transactions, month)).agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    )
