"""Gold: aggregates over silver tables.

All groupings aggregate inside each task before the shuffle, so a hot branch or customer sends one
partial row per task, and the customer view joins sides that hold one row per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.aggregates import conditional_count
from ..functions.status import worst_status


def branch_txn_summary(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("branch_code", "txn_type", "channel", "txn_month").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.count_distinct("customer_id").alias("unique_customers"),
        conditional_count(F.col("is_flagged")).alias("flagged_count"),
    )


def npa_classification_summary(loans: DataFrame) -> DataFrame:
    return loans.groupBy("npa_status", "loan_type", "branch_code").agg(
        F.count("*").alias("account_count"),
        F.sum("outstanding_principal").alias("total_outstanding"),
        F.sum("sanctioned_amount").alias("total_sanctioned"),
        F.avg("interest_rate").alias("avg_interest_rate"),
        F.avg("dpd").alias("avg_dpd"),
    )


def transactions_per_customer(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.count("*").alias("total_txns"),
        F.sum("amount").alias("total_txn_amount"),
        F.max("txn_date").alias("last_txn_date"),
        conditional_count(F.col("is_flagged")).alias("flagged_txns"),
    )


def loans_per_customer(loans: DataFrame, worst_by: str = "severity") -> DataFrame:
    return loans.groupBy("customer_id").agg(
        F.count("*").alias("total_loans"),
        F.sum("outstanding_principal").alias("total_loan_outstanding"),
        F.max("dpd").alias("max_dpd"),
        worst_status("npa_status", worst_by).alias("worst_npa_status"),
    )


def customer_360(
    customers: DataFrame, transactions: DataFrame, loans: DataFrame, worst_by: str = "severity"
) -> DataFrame:
    """One row per customer with transaction and loan measures, NULL where there are none.

    ``worst_by="lexical"`` takes the alphabetically last status instead of the most severe one.
    """
    return (
        customers.select("customer_id", "name", "risk_category", "kyc_status", "branch_code")
        .join(transactions_per_customer(transactions), "customer_id", "left")
        .join(loans_per_customer(loans, worst_by), "customer_id", "left")
    )
