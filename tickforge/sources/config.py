"""Config text -> DataFrames (ticker list, series map)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.text import normalise_ticker, split_list

# Default ticker list.
DEFAULT_TICKERS = "PETR4,VALE3,ITUB4,BBDC4,BBAS3,ABEV3,WEGE3,MGLU3,ELET3,B3SA3"


def ticker_list(spark: SparkSession, text: str = DEFAULT_TICKERS, normalise: bool = True) -> DataFrame:
    """Comma text -> DataFrame(position, symbol): split, trim, drop blanks."""
    items = F.posexplode(split_list(F.lit(text)))
    df = spark.range(1).select(items.alias("position", "symbol"))
    return df.withColumn("symbol", normalise_ticker("symbol")) if normalise else df


def explode_list(df: DataFrame, text_col: str, out: str = "item", pos: str = "pos") -> DataFrame:
    """A comma-text column -> one row per non-blank item (original position kept)."""
    parts = F.posexplode(F.split(F.col(text_col), ","))
    rows = df.select("*", parts.alias(pos, "__raw"))
    return (rows.withColumn(out, F.trim("__raw"))
            .filter(F.col(out) != "")
            .drop("__raw"))
