"""Silver: typed, deduplicated, masked.

Each builder takes a bronze DataFrame and returns the silver one.  Blank text becomes NULL first,
values that do not parse become NULL, rows without a key are dropped, and one row per key is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casting import cast_as, to_decimal
from ..functions.aggregates import rounded_ratio
from ..functions.text import blank_to_null, mask_email, mask_mobile, mask_pan
from ..rules import DEFAULT_RULES, Rules
from ..specs import AML_ALERTS, BUREAU, CUSTOMERS, LMS_LOANS, NPA_REPORT, TRANSACTIONS, EntitySpec
from .dedup import RECENCY, as_one_text, latest_per_key, texts_of


def _clean(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Known columns with blanks as NULL, one row per key: the latest arrival, ties by all columns in turn.

    The columns travel through the deduplicating sorts and shuffle as one text that sorts as they do:
    as columns of their own they take twice the room."""
    columns = [blank_to_null(F.col(c).cast("string")).alias(c) for c in spec.columns]
    recency = [c for c in RECENCY if c in bronze.columns]
    rest = [c for c in spec.columns if c != spec.key]
    narrow = bronze.select(*columns, *recency).select(spec.key, *recency, as_one_text(rest).alias("_rest"))
    order = [F.col(c).desc_nulls_last() for c in [*recency, "_rest"]]
    return texts_of(latest_per_key(narrow, spec.key, order), "_rest", rest).select(*spec.columns)


def _typed(spec: EntitySpec) -> dict[str, Column]:
    return {name: cast_as(name, type_name) for name, type_name in spec.casts.items()}


def silver_transactions(bronze: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Typed transactions with month, hour and the high-value and flagged marks.

    ``is_high_value`` is false for an unknown amount; ``is_flagged`` is NULL for an unknown status.
    """
    typed = _clean(bronze, TRANSACTIONS).withColumns(_typed(TRANSACTIONS))
    return typed.withColumns({
        "ingestion_ts": F.current_timestamp(),
        "txn_month": F.date_format("txn_date", "yyyy-MM"),
        "txn_hour": F.hour("txn_date"),
        "is_high_value": F.when(F.col("amount") >= rules.high_value_min, True).otherwise(False),
        "is_flagged": F.col("status") == rules.flagged_status,
    })


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Customers with tax number, mobile and e-mail masked."""
    masked = {"pan": mask_pan("pan"), "mobile": mask_mobile("mobile"), "email": mask_email("email")}
    # Masked columns go last, in the order of the published contract.
    kept = [c for c in CUSTOMERS.columns if c not in masked]
    return (
        _clean(bronze, CUSTOMERS)
        .withColumns({**_typed(CUSTOMERS), **masked, "ingestion_ts": F.current_timestamp()})
        .select(*kept, "ingestion_ts", *masked)
    )


def silver_loans(bronze: DataFrame, source: str = "npa") -> DataFrame:
    """Typed loans with the loan-to-value ratio, from the NPA report or the loan system's extract.

    The NPA report has no interest rate: there ``interest_rate`` is the provision percentage, as
    consumers of that table expect.  The loan system (``source="lms"``) has the real rate, the last
    payment and the next due date.
    """
    specs = {"npa": NPA_REPORT, "lms": LMS_LOANS}
    if source not in specs:
        raise ValueError(f"source must be 'npa' or 'lms', not {source!r}")
    spec = specs[source]
    typed = _clean(bronze, spec).withColumns(_typed(spec))
    if source == "npa":
        typed = typed.withColumn("interest_rate", to_decimal("provision_required_pct", 5, 2))
    principal, collateral = F.col("outstanding_principal"), F.col("collateral_value")
    ltv = F.when(collateral > 0, rounded_ratio(principal * 100, collateral)).otherwise(F.lit(None))
    return typed.withColumns({"ltv_ratio": ltv, "ingestion_ts": F.current_timestamp()})


def silver_bureau(bronze: DataFrame) -> DataFrame:
    """Typed credit-bureau reports; the tax number is masked here too."""
    return (
        _clean(bronze, BUREAU)
        .withColumns({**_typed(BUREAU), "pan": mask_pan("pan"), "ingestion_ts": F.current_timestamp()})
    )


def silver_aml_alerts(bronze: DataFrame) -> DataFrame:
    """Typed alerts."""
    return (
        _clean(bronze, AML_ALERTS)
        .withColumns({**_typed(AML_ALERTS), "ingestion_ts": F.current_timestamp()})
    )
