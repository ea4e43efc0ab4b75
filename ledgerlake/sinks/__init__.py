"""Writers: tables (append, full refresh, published refresh), files and message envelopes."""

from .contract import ContractError, conforming, contract_actions
from .curve import Curve, along_curve
from .envelopes import preview, to_envelopes, write_envelopes
from .files import write_extract, write_json_lines
from .publish import Buckets, PublishResult, append, create_namespace, publish, replace

__all__ = [
    "Buckets", "ContractError", "Curve", "PublishResult", "along_curve", "append", "conforming", "contract_actions", "create_namespace", "preview",
    "publish", "replace", "to_envelopes", "write_envelopes", "write_extract", "write_json_lines",
]
