"""Registry of the six entities: key, columns, types, topic and table names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    MONEY: T.DecimalType(18, 2),
}


@dataclass(frozen=True)
class EntitySpec:
    """One entity as it arrives: all columns are strings until silver types them."""

    name: str
    key: str
    columns: tuple[str, ...]
    casts: dict[str, str] = field(default_factory=dict)
    topic: str | None = None
    bronze_table: str = ""
    silver_table: str = ""
    required: bool = False

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        """Declared types, used when a CSV extract is read typed instead of raw."""
        return T.StructType([
            T.StructField(c, _TYPES[self.casts.get(c, "string")]) for c in self.columns
        ])


# Entity columns, keys, topics and table names.
TRANSACTIONS = EntitySpec(
    name="transactions",
    key="txn_id",
    columns=(
        "txn_id", "account_id", "customer_id", "txn_type", "amount", "currency", "txn_date",
        "value_date", "branch_code", "channel", "narration", "balance_after", "status", "ref_number",
    ),
    casts={"amount": MONEY, "txn_date": "timestamp", "balance_after": MONEY},
    topic="finacle-transactions",
    bronze_table="finacle_transactions",
    silver_table="finacle_transactions",
    required=True,
)

CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    columns=(
        "customer_id", "name", "pan", "aadhaar_masked", "mobile", "email", "dob", "gender",
        "kyc_status", "kyc_date", "risk_category", "branch_code", "account_type", "account_number",
        "account_open_date", "occupation", "annual_income", "address_city", "address_state",
        "nominee_name",
    ),
    casts={"annual_income": MONEY},
    topic="finacle-customers",
    bronze_table="finacle_customers",
    silver_table="finacle_customers",
    required=True,
)

AML_ALERTS = EntitySpec(
    name="aml_alerts",
    key="alert_id",
    columns=(
        "alert_id", "customer_id", "customer_name", "alert_date", "alert_type", "risk_score",
        "rule_triggered", "transaction_ids", "total_amount", "currency", "description", "status",
        "assigned_to", "priority", "due_date", "resolution", "resolution_date", "sar_filed",
        "sar_reference",
    ),
    casts={"risk_score": "int", "total_amount": MONEY},
    topic="aml-alerts",
    bronze_table="aml_alerts",
    silver_table="aml_alerts",
)

BUREAU = EntitySpec(
    name="bureau",
    key="report_id",
    columns=(
        "report_id", "customer_id", "customer_name", "pan", "cibil_score", "score_date",
        "total_accounts", "active_accounts", "closed_accounts", "overdue_accounts",
        "total_outstanding", "secured_outstanding", "unsecured_outstanding",
        "credit_utilization_pct", "enquiry_count_6m", "enquiry_count_12m", "dpd_30_count",
        "dpd_60_count", "dpd_90_count", "written_off_amount", "suit_filed_count",
        "wilful_defaulter", "report_pull_date", "report_source",
    ),
    casts={
        "cibil_score": "int", "total_outstanding": MONEY, "secured_outstanding": MONEY,
        "unsecured_outstanding": MONEY, "credit_utilization_pct": "int", "written_off_amount": MONEY,
    },
    topic="cibil-bureau",
    bronze_table="cibil_bureau",
    silver_table="cibil_bureau",
)

NPA_REPORT = EntitySpec(
    name="npa_report",
    key="loan_id",
    columns=(
        "report_date", "loan_id", "customer_id", "customer_name", "loan_type", "branch_code",
        "sanctioned_amount", "outstanding_principal", "outstanding_interest", "total_outstanding",
        "dpd", "asset_classification", "npa_status", "npa_date", "provision_required_pct",
        "provision_amount", "collateral_type", "collateral_value", "net_npa_exposure",
        "recovery_action", "recovery_amount", "last_review_date", "next_review_date",
        "relationship_manager", "remarks",
    ),
    casts={
        "sanctioned_amount": MONEY, "outstanding_principal": MONEY, "outstanding_interest": MONEY,
        "total_outstanding": MONEY, "dpd": "int", "provision_amount": MONEY,
        "collateral_value": MONEY,
    },
    topic="npa-report",
    bronze_table="npa_report",
    silver_table="lms_loans",
    required=True,
)

LMS_LOANS = EntitySpec(
    name="lms_loans",
    key="loan_id",
    columns=(
        "loan_id", "customer_id", "customer_name", "loan_type", "product_code",
        "sanctioned_amount", "disbursed_amount", "outstanding_principal", "outstanding_interest",
        "interest_rate", "emi_amount", "tenure_months", "remaining_tenure", "disbursement_date",
        "maturity_date", "dpd", "npa_status", "asset_classification", "provision_percent",
        "last_payment_date", "last_payment_amount", "next_due_date", "collateral_type",
        "collateral_value", "branch_code", "relationship_manager",
    ),
    casts={
        "sanctioned_amount": MONEY, "disbursed_amount": MONEY, "outstanding_principal": MONEY,
        "outstanding_interest": MONEY, "interest_rate": "decimal(5,2)", "emi_amount": MONEY,
        "dpd": "int", "provision_percent": "decimal(5,2)", "last_payment_amount": MONEY,
        "collateral_value": MONEY,
    },
    bronze_table="lms_loans",
    silver_table="lms_loans",
)

SPECS: dict[str, EntitySpec] = {
    s.name: s for s in (TRANSACTIONS, CUSTOMERS, AML_ALERTS, BUREAU, NPA_REPORT, LMS_LOANS)
}
TOPICS: dict[str, EntitySpec] = {s.topic: s for s in SPECS.values() if s.topic}


def route(topic: str | None = None) -> dict[str, EntitySpec]:
    """All topics with their entity, or only the one asked for."""
    if topic is None:
        return dict(TOPICS)
    if topic not in TOPICS:
        raise KeyError(f"unknown topic {topic!r}; known: {sorted(TOPICS)}")
    return {topic: TOPICS[topic]}
