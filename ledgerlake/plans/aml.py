"""Money-laundering reports: flagged transactions, structuring, large cash, open alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casting import strict_int, to_money
from ..functions.text import blank_to_null, normalised
from ..operators.skew import SALT, TASK_ROWS, copy_per_salt, heavy_keys, salt_rows
from ..operators.topk import top_k
from ..rules import DEFAULT_RULES, Rules

_CASH_COLUMNS = ("txn_id", "customer_id", "name", "amount", "channel", "narration", "txn_date")


def flagged_detail(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Flagged transactions with their customer, largest first."""
    flagged = transactions.filter("is_flagged").select(
        "txn_id", "customer_id", "amount", "channel", "narration", "txn_date"
    )
    who = customers.select("customer_id", F.col("name").alias("customer_name"), "risk_category", "kyc_status")
    joined = flagged.join(who, "customer_id").select(
        "txn_id", "customer_id", "customer_name", "risk_category", "kyc_status", "amount", "channel",
        "narration", "txn_date",
    )
    return top_k(joined, F.col("amount").desc_nulls_last(), None, "txn_id")


def _repeatedly_flagged(transactions: DataFrame, rules: Rules) -> DataFrame:
    """Count and sum of the flagged transactions of customers who have several."""
    totals = transactions.filter("is_flagged").groupBy("customer_id").agg(
        F.count("*").alias("flagged_count"), F.sum("amount").alias("total_flagged_amount")
    )
    return totals.filter(F.col("flagged_count") >= rules.structuring_min)


def structuring(transactions: DataFrame, customers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Customers with several flagged transactions, one row each; ``structuring_ids`` lists those."""
    return (
        _repeatedly_flagged(transactions, rules)
        .join(customers.select("customer_id", "name", "risk_category"), "customer_id")
        .select("customer_id", "name", "risk_category", "flagged_count", "total_flagged_amount")
        .orderBy(F.col("flagged_count").desc(), "customer_id")
    )


def structuring_ids(
    transactions: DataFrame, customers: DataFrame, rules: Rules = DEFAULT_RULES, task_rows: int = TASK_ROWS
) -> DataFrame:
    """The flagged transactions of those customers, one row each, so that no task holds all of a customer's."""
    totals = _repeatedly_flagged(transactions, rules).select("customer_id", "flagged_count")
    known = totals.join(customers.select("customer_id"), "customer_id", "left_semi")
    heavy = heavy_keys(totals, "customer_id", "flagged_count", totals.agg(F.sum("flagged_count")).scalar(), task_rows)
    flagged = transactions.filter("is_flagged").select("customer_id", "txn_id")
    return (
        salt_rows(flagged, heavy, "customer_id", ["txn_id"])
        .join(copy_per_salt(known, heavy, "customer_id"), ["customer_id", SALT])
        .select("customer_id", "txn_id")
    )


def high_value_cash(
    transactions: DataFrame, customers: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Cash transactions at or above the reporting threshold (silver)."""
    cash = transactions.filter(
        (F.col("channel") == rules.cash_channel) & (F.col("amount") >= rules.cash_report_min)
    )
    joined = cash.join(customers.select("customer_id", "name"), "customer_id").select(*_CASH_COLUMNS)
    return top_k(joined, F.col("amount").desc_nulls_last(), None, "txn_id")


def high_value_cash_raw(
    transactions: DataFrame, customers: DataFrame, rules: Rules = DEFAULT_RULES, k: int = 20
) -> DataFrame:
    """The same on bronze text: channel spelling is forgiven, unknown customers are kept, top ``k``.

    Only the ``k`` largest transactions meet the customers: each of them yields at least one row of
    the result, so no other transaction can reach the top ``k``.
    """
    amount = to_money("amount")
    cash = transactions.filter(
        (normalised("channel") == rules.cash_channel) & (amount >= rules.cash_report_min)
    ).withColumn("amount", amount)
    largest = top_k(
        cash.select(*[c for c in _CASH_COLUMNS if c != "name"]), F.col("amount").desc(), k, "txn_id"
    )
    joined = largest.join(customers.select("customer_id", "name"), "customer_id", "left")
    return top_k(joined.select(*_CASH_COLUMNS), F.col("amount").desc(), k, "txn_id", "name")


def open_alerts(alerts: DataFrame, k: int = 20, customers: DataFrame | None = None) -> DataFrame:
    """Open alerts by risk score (bronze).

    Derived alerts carry no customer name; ``customers`` fills it in for the rows shown.
    """
    rows = alerts.filter(normalised("status") == "OPEN").select(
        "alert_id", "customer_id", "customer_name", "alert_type",
        strict_int("risk_score").alias("risk_score"), to_money("total_amount").alias("total_amount"),
        "status", "priority", "alert_date",
    )
    shown = top_k(rows, F.col("risk_score").desc_nulls_last(), k, "alert_id")
    if customers is None:
        return shown
    names = customers.select("customer_id", F.col("name").alias("_name"))
    named = shown.join(names, "customer_id", "left").withColumn(
        "customer_name", F.coalesce(blank_to_null("customer_name"), "_name")
    )
    return top_k(named.select(*rows.columns), F.col("risk_score").desc_nulls_last(), k, "alert_id")
