"""Bronze cleaning rules, as Spark expressions (no driver-side pandas).

Parity defaults: unparseable / missing numbers become 0.0 (``null_fill=0.0``);
pass ``null_fill=None`` to keep them NULL so the silver checks can see them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.dates import clamp_start, end_of_day_bound, try_parse_date_text
from tickforge.functions.numeric import tolerant_double

# Numeric columns of a bronze quote row.
QUOTE_NUMERIC = ["Open", "High", "Low", "Close", "Volume", "Dividends", "Stock_Splits"]


def stamp_ingestion(df: DataFrame, run_ts: _dt.datetime | None = None,
                    col: str = "ingestion_timestamp") -> DataFrame:
    """One ingestion instant per run: a literal, or ``current_timestamp()``
    (constant within a query)."""
    value = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    return df.withColumn(col, value)


def rename_spaced(df: DataFrame, renames: dict | None = None) -> DataFrame:
    """Rename the spaced variant ``Stock Splits`` (no-op when absent)."""
    renames = renames or {"Stock Splits": "Stock_Splits"}
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def add_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def _as_timestamp(df: DataFrame, col: str, fmt: str | None):
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return try_parse_date_text(col, fmt) if fmt else F.col(col).try_cast("timestamp")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.timestamp_seconds(F.col(col))
    if isinstance(dtype, T.DateType):
        return F.col(col).cast("timestamp")
    return F.col(col)


def clean_quotes(df: DataFrame, date: str = "Date", numeric=QUOTE_NUMERIC,
                 null_fill: float | None = 0.0, date_fmt: str | None = None) -> DataFrame:
    """Tolerant date parse, drop rows without a date, tolerant numbers
    (text / NaN -> NULL), then fill NULL numbers with ``null_fill``."""
    df = rename_spaced(df)
    out = df.withColumn(date, _as_timestamp(df, date, date_fmt)).filter(F.col(date).isNotNull())
    cols = {c: tolerant_double(F.col(c)) for c in numeric if c in out.columns}
    out = out.withColumns(cols)
    if null_fill is not None:
        out = out.na.fill(float(null_fill), subset=list(cols))
    return out


def bad_series_row(date: str = "data", value: str = "valor", date_fmt: str | None = None):
    """Predicate: the row has no usable date or value."""
    d = try_parse_date_text(date, date_fmt) if date_fmt else F.col(date)
    return d.isNull() | tolerant_double(F.col(value)).isNull()


def clean_series(df: DataFrame, date: str = "data", value: str = "valor", serie: str = "serie",
                 date_fmt: str | None = None, value_fill: float = 0.0,
                 serie_fill: str = "NA") -> DataFrame:
    """Parse, drop rows without date or value, then fill what is left
    (``valor`` -> 0.0, ``serie`` -> 'NA'): one pass, drop before fill."""
    d = try_parse_date_text(date, date_fmt) if date_fmt else _as_timestamp(df, date, None)
    out = (df.withColumn(date, d)
           .withColumn(value, tolerant_double(F.col(value)))
           .na.drop("any", subset=[date, value]))
    return out.na.fill({value: value_fill, serie: serie_fill})


def dropped_per_series(df: DataFrame, date: str = "data", value: str = "valor",
                       serie: str = "serie", date_fmt: str | None = None) -> DataFrame:
    """Rows the cleaning drops, per series (counted before the drop, one pass)."""
    bad = bad_series_row(date, value, date_fmt) if date_fmt else (
        _as_timestamp(df, date, None).isNull() | tolerant_double(F.col(value)).isNull())
    return df.groupBy(serie).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(bad).alias("rows_dropped"),
    )


def date_window(df: DataFrame, start, end, date: str = "Date", max_days: int | None = None,
                fmt: str = "d/M/yyyy") -> DataFrame:
    """Keep ``start' <= date <= end 00:00`` where ``start'`` is ``start``, cut to
    the last ``max_days`` days before ``end`` if that is given. With literal dates Catalyst
    folds both bounds to constants and pushes them to the scan."""
    lo = clamp_start(start, end, max_days, fmt).cast("timestamp")
    hi = end_of_day_bound(end, fmt)
    return df.filter((F.col(date).cast("timestamp") >= lo) & (F.col(date).cast("timestamp") <= hi))
