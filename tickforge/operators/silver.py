"""Silver layer: column-name normalisation and the two typed projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.numeric import tolerant_double


def normal_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn spaces into underscores.

    Metadata only (no data touched). Two inputs mapping to one name (``Date``
    and ``date``) would silently merge, so that is rejected.
    """
    names = [normal_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*names)


# Bronze -> silver column mapping of quotes, in output order.
EQUITY_RENAMES = [
    ("date", "trade_date"),
    ("open", "open_price"),
    ("high", "high_price"),
    ("low", "low_price"),
    ("close", "close_price"),
    ("volume", "volume"),
    ("dividends", "div_cash"),
    ("stock_splits", "split_ratio"),
    ("ticker", "symbol"),
    ("ingestion_timestamp", "ingestion_timestamp"),
]


def silver_equity(bronze: DataFrame) -> DataFrame:
    """Bronze quotes -> silver equity (10 columns, renamed)."""
    df = normalise_columns(bronze)
    cols = [F.col(src).alias(dst) for src, dst in EQUITY_RENAMES if src in df.columns]
    return df.select(*cols)


def silver_macro(bronze: DataFrame, frequency: str | dict | Column = "D") -> DataFrame:
    """Bronze series -> silver macro: rename, value as double, frequency label.

    ``frequency`` is a constant (default ``'D'``), a ``{serie: code}`` dict,
    or a Column.
    """
    df = normalise_columns(bronze)
    if isinstance(frequency, dict):
        freq = F.lit(None).cast("string")
        for k, v in frequency.items():
            freq = F.when(F.col("serie") == F.lit(k), F.lit(v)).otherwise(freq)
        freq = F.coalesce(freq, F.lit("D"))
    elif isinstance(frequency, Column):
        freq = frequency
    else:
        freq = F.lit(frequency)
    cols = [
        F.col("data").alias("ref_date"),
        tolerant_double(F.col("valor")).alias("idx_value"),
        F.col("serie").alias("idx_type"),
        freq.alias("frequency"),
    ]
    if "ingestion_timestamp" in df.columns:
        cols.append(F.col("ingestion_timestamp"))
    return df.select(*cols)
