"""Date helpers. All of them are plain Spark expressions, so with literal
arguments Catalyst folds them to constants and pushes the filters down."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text date formats used by the sources.
BR_DATE = "d/M/yyyy"
ISO_DATE = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_parse_date_text(c, fmt: str = BR_DATE) -> Column:
    """Text -> timestamp at midnight; bad text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_date_text(c, fmt: str = BR_DATE) -> Column:
    """Text -> timestamp; bad text raises (ANSI)."""
    return F.to_timestamp(_c(c), fmt)


def reformat_date_text(c, in_fmt: str = BR_DATE, out_fmt: str = ISO_DATE,
                       strict: bool = False) -> Column:
    """Re-format date text. ``strict`` fails the query on text that does not
    parse (whatever the ANSI setting); otherwise such text gives NULL."""
    parsed = try_parse_date_text(c, in_fmt)
    out = F.date_format(parsed, out_fmt)
    if not strict:
        return out
    bad = parsed.isNull() & _c(c).isNotNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"date not in format {in_fmt}: "), _c(c)))) \
            .otherwise(out)


def as_date(v, fmt: str = BR_DATE) -> Column:
    """A date argument given as text (``fmt``), date, or Column -> DATE column."""
    if isinstance(v, str):
        return F.to_date(F.lit(v), fmt)
    if isinstance(v, _dt.datetime):
        return F.lit(v.date())
    if isinstance(v, _dt.date):
        return F.lit(v)
    return F.to_date(v)


def clamp_start(start, end, max_days: int | None = None, fmt: str = BR_DATE) -> Column:
    """Start of a requested span; ``max_days`` cuts it to the last days before
    ``end`` (the limit of a data service's plan, only on request)."""
    s, e = as_date(start, fmt), as_date(end, fmt)
    if max_days is None:
        return s
    return F.greatest(s, F.date_sub(e, max_days))


def end_of_day_bound(end, fmt: str = BR_DATE) -> Column:
    """The end date compared as a timestamp at midnight (so 13:00 that day is out)."""
    return F.to_timestamp(as_date(end, fmt))


def month_key(c) -> Column:
    """'yyyy-MM' of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM")
