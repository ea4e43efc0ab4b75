"""Loan classification and provisioning reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.aggregates import money_avg, rounded_ratio
from ..functions.casting import strict_int, to_money
from ..functions.status import provision_pct, severity_rank
from ..functions.text import normalised
from ..operators.topk import top_k
from ..rules import DEFAULT_RULES, Rules


def _whole_avg(column: str):
    """Average of an int column rounded half up to a whole number."""
    exact = F.col(column).cast("decimal(20,0)")
    return rounded_ratio(F.sum(exact), F.count(exact).cast("decimal(20,0)"), 0)


def npa_from_raw(bronze: DataFrame) -> DataFrame:
    """Accounts, principal and average days past due per status, on bronze text."""
    valid = bronze.select(
        normalised("npa_status").alias("npa_status"),
        to_money("outstanding_principal").alias("principal"),
        strict_int("dpd").alias("dpd"),
    ).filter(F.col("principal").isNotNull())
    return valid.groupBy("npa_status").agg(
        F.count("*").alias("accounts"),
        F.sum("principal").alias("total_outstanding"),
        _whole_avg("dpd").alias("avg_dpd"),
    ).orderBy(F.col("total_outstanding").desc_nulls_last(), "npa_status")


def npa_regulatory(loans: DataFrame) -> DataFrame:
    """Summary in regulatory order, mildest status first and unknown ones last."""
    return loans.groupBy("npa_status").agg(
        F.count("*").alias("account_count"),
        F.sum("outstanding_principal").alias("total_outstanding"),
        F.sum("sanctioned_amount").alias("total_sanctioned"),
        money_avg("interest_rate").alias("avg_rate"),
        _whole_avg("dpd").alias("avg_dpd"),
    ).orderBy(severity_rank("npa_status").asc_nulls_last(), "npa_status")


def approaching_npa(loans: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Loans one or two steps from non-performing, most overdue first (loan-system loans)."""
    watched = loans.filter(F.col("npa_status").isin(*rules.watch_statuses)).select(
        "loan_id", "customer_id", "customer_name", "loan_type", "outstanding_principal", "dpd",
        "npa_status", "last_payment_date", "next_due_date", "collateral_type", "collateral_value",
        "ltv_ratio",
    )
    return top_k(watched, F.col("dpd").desc_nulls_last(), None, "loan_id")


def provision_requirement(loans: DataFrame, with_reported: bool = False) -> DataFrame:
    """Provision by the status rule; ``with_reported`` adds the sum of the report's own figures."""
    measures = [F.count("*").alias("accounts"), F.sum("outstanding_principal").alias("total_outstanding")]
    if with_reported:
        measures.append(F.sum("provision_amount").alias("reported_provision"))
    pct = provision_pct("npa_status")
    amount = F.round(F.col("total_outstanding") * pct / 100, 2).cast("decimal(28,2)")
    summary = loans.groupBy("npa_status").agg(*measures).withColumns(
        {"provision_pct": pct, "provision_amount": amount}
    )
    return summary.orderBy(severity_rank("npa_status").asc_nulls_last(), "npa_status")
