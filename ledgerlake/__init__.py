"""Banking lakehouse analytics as plain DataFrame functions.

Layers: keyed JSON messages or CSV extracts -> bronze (raw strings) -> silver
(typed, deduplicated, masked) -> gold (aggregates) -> reports.  Every builder
takes DataFrames and returns a DataFrame; nothing runs until the caller acts.
"""

__version__ = "0.1.0"
