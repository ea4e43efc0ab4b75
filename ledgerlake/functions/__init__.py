"""Column expressions; all of them compile to built-in Spark expressions."""

from .aggregates import conditional_count, money_avg, percent_of, rounded_ratio
from .casting import strict_int, to_int, to_money, to_decimal, to_timestamp
from .status import nth, provision_pct, severity_rank, worst_status
from .text import blank_to_null, is_blank, mask_email, mask_mobile, mask_pan, normalised

__all__ = [
    "blank_to_null", "conditional_count", "is_blank", "mask_email", "mask_mobile", "mask_pan",
    "money_avg", "normalised", "nth", "percent_of", "provision_pct", "rounded_ratio", "severity_rank",
    "strict_int", "to_decimal", "to_int", "to_money", "to_timestamp", "worst_status",
]
