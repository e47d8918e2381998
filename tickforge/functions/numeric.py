"""Null-safe arithmetic. ANSI mode stays on; every ratio goes through
``try_divide`` so a zero or missing denominator gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    return F.try_divide(_c(num), _c(den))


def simple_return(cur, prev) -> Column:
    """cur / prev - 1; NULL when prev is NULL or zero."""
    return safe_ratio(cur, prev) - F.lit(1.0)


def pct_change(cur, prev) -> Column:
    """(cur / prev - 1) * 100; NULL when prev is NULL or zero."""
    return simple_return(cur, prev) * F.lit(100.0)


def tolerant_double(c) -> Column:
    """Text or number -> double; unparseable text and NaN become NULL."""
    v = _c(c).try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))
