"""Customer reports: the 360 listing, low bureau scores, high-risk customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casting import strict_int, to_money
from ..operators.skew import SALT, TASK_ROWS, copy_per_salt, heavy_keys, salt_rows
from ..operators.topk import top_k
from ..rules import DEFAULT_RULES, Rules
from ..session import stored


def customer_360_listing(gold: DataFrame) -> DataFrame:
    return top_k(gold, F.col("total_txn_amount").desc_nulls_last(), None, "customer_id")


def low_scores(bureau: DataFrame, rules: Rules = DEFAULT_RULES, k: int = 20) -> DataFrame:
    """Lowest bureau scores below the threshold (bronze)."""
    rows = bureau.select(
        "customer_id", "customer_name", strict_int("cibil_score").alias("cibil_score"),
        to_money("total_outstanding").alias("total_outstanding"),
        strict_int("dpd_90_count").alias("dpd_90_count"), "wilful_defaulter", "report_pull_date",
    ).filter(F.col("cibil_score") < rules.low_score_below)
    return top_k(rows, F.col("cibil_score").asc(), k, "customer_id")


def high_risk_customers(
    customers: DataFrame,
    bureau: DataFrame,
    loans: DataFrame,
    transactions: DataFrame,
    rules: Rules = DEFAULT_RULES,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Customers with a low score, a risky loan or flagged transactions.

    One row per customer, distinct score and distinct loan position.  Needs silver inputs, in which
    customer and transaction ids are unique: transactions are counted per customer before they meet
    the loans, so nothing fans out, and the counts equal those of distinct ids.

    The distinct loan positions are stored once, so the loans are read once.  Positions of a customer
    with more than a task should hold are spread over salts; copies of a borrower that meet no position
    on their salt are dropped again.
    """
    key = "customer_id"
    flagged = transactions.filter("is_flagged").groupBy(key).agg(F.count("*").alias("flagged_txns"))
    scores = bureau.select(key, "cibil_score").distinct()
    position = ["worst_loan_status", "max_dpd", "loan_outstanding"]
    positions = stored(loans.select(
        key,
        F.col("npa_status").alias("worst_loan_status"),
        F.col("dpd").alias("max_dpd"),
        F.col("outstanding_principal").alias("loan_outstanding"),
    ).distinct(), "loan-positions").withColumn("_found", F.lit(True))
    borrowers = positions.groupBy(key).agg(F.count("*").alias("_loans"))
    heavy = heavy_keys(borrowers, key, "_loans", borrowers.agg(F.sum("_loans")).scalar(), task_rows)
    known = (
        customers.select(key, "name", "risk_category", "kyc_status")
        .join(scores, key, "left")
        .join(flagged, key, "left")
        .join(borrowers, key, "left")
        .withColumn("flagged_txns", F.coalesce("flagged_txns", F.lit(0).cast("bigint")))
    )
    at_risk = (
        (F.col("cibil_score") < rules.low_score_below)
        | F.col("worst_loan_status").isin(*rules.risk_statuses)
        | (F.col("flagged_txns") > 0)
    )
    return (
        copy_per_salt(known, heavy, key)
        .join(salt_rows(positions, heavy, key, position), [key, SALT], "left")
        .filter((F.col("_found") | F.col("_loans").isNull()) & at_risk)
        .select(key, "name", "risk_category", "kyc_status", "cibil_score", *position, "flagged_txns")
        .orderBy(F.col("cibil_score").asc_nulls_last(), key, *position)
    )
