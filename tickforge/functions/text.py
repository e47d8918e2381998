"""Text helpers for tickers and comma lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: exchange suffix removed from tickers (literal, case-sensitive).
TICKER_SUFFIX = ".SA"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_ticker(c, suffix: str = TICKER_SUFFIX) -> Column:
    """Drop the literal suffix, then upper-case (so a lower-case suffix stays)."""
    return F.upper(F.replace(_c(c), F.lit(suffix), F.lit("")))


def split_list(c, sep: str = ",") -> Column:
    """Comma text -> array of trimmed, non-blank items (order kept)."""
    items = F.transform(F.split(_c(c), sep), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != F.lit(""))
