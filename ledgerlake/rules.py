"""Business thresholds and lookup values, all overridable per call."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Loan statuses from least to most severe.
SEVERITY_ORDER = ("STANDARD", "SMA-1", "SMA-2", "NPA")

# Share of the outstanding principal to be set aside, in percent.
PROVISION_PCT = {
    "STANDARD": Decimal("0.40"),
    "SMA-1": Decimal("5.00"),
    "SMA-2": Decimal("15.00"),
    "NPA": Decimal("25.00"),
}


@dataclass(frozen=True)
class Rules:
    """Thresholds used by the silver and gold layers and by the reports."""

    high_value_min: int = 200_000
    cash_report_min: int = 1_000_000
    cash_channel: str = "CASH"
    flagged_status: str = "FLAGGED"
    low_score_below: int = 600
    structuring_min: int = 2
    override_cash_above: int = 500_000
    risk_statuses: tuple[str, ...] = ("NPA", "SMA-2")
    watch_statuses: tuple[str, ...] = ("SMA-1", "SMA-2")


DEFAULT_RULES = Rules()
