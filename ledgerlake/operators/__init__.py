"""Building blocks of the layers: message parsing, deduplication, silver and gold tables, alerts."""

from .alerts import alert_base, override_cash_status
from .bronze import ingest_batch, ingest_extract, parse_envelopes, split_messages, unseen
from .dedup import latest_per_key
from .gold import branch_txn_summary, customer_360, npa_classification_summary
from .silver import (
    silver_aml_alerts, silver_bureau, silver_customers, silver_loans, silver_transactions,
)
from .topk import top_k, with_position

__all__ = [
    "alert_base", "branch_txn_summary", "customer_360", "ingest_batch", "ingest_extract", "latest_per_key",
    "npa_classification_summary", "override_cash_status", "parse_envelopes", "silver_aml_alerts",
    "silver_bureau", "silver_customers", "silver_loans", "silver_transactions", "split_messages", "top_k", "unseen", "with_position",
]
