"""Transaction rules: status override and alerts for flagged transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..rules import DEFAULT_RULES, Rules


def override_cash_status(transactions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Large cash transactions are flagged whatever their status says."""
    large_cash = (F.col("channel") == rules.cash_channel) & (F.col("amount") > rules.override_cash_above)
    return transactions.withColumn(
        "status", F.when(large_cash, rules.flagged_status).otherwise(F.col("status"))
    )


def alert_base(transactions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What an alert takes over from each flagged transaction: its own id, the customer, day and amount.

    The alert id is made of the day and the transaction id, so alerts cannot collide; without a date it
    has eight zeros.
    """
    key = F.col("txn_id").cast("string")
    day = F.coalesce(F.date_format("txn_date", "yyyyMMdd"), F.lit("0" * 8))
    return transactions.filter(F.col("status") == rules.flagged_status).select(
        F.format_string("AML%s-%s", day, key).alias("alert_id"),
        "customer_id",
        F.substring(F.date_format("txn_date", "yyyy-MM-dd HH:mm:ss"), 1, 10).alias("alert_date"),
        key.alias("transaction_ids"),
        F.col("amount").alias("total_amount"),
    )
