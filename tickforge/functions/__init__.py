"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side)."""

from tickforge.functions.numeric import pct_change, safe_ratio, simple_return, tolerant_double
from tickforge.functions.dates import (
    clamp_start, end_of_day_bound, month_key, parse_date_text, reformat_date_text,
    try_parse_date_text,
)
from tickforge.functions.text import normalise_ticker, split_list

__all__ = [
    "pct_change", "safe_ratio", "simple_return", "tolerant_double",
    "clamp_start", "end_of_day_bound", "month_key", "parse_date_text",
    "reformat_date_text", "try_parse_date_text",
    "normalise_ticker", "split_list",
]
