"""Inputs derived by Spark from the shared test tables for the registered
queries: bronze-shaped bars, and bars / series rows broken by fixed rules
(the rules are plain functions of the day of month), with DuckDB forms."""

from __future__ import annotations

from pyspark.sql import functions as F


def bronze_like(bars):
    """Bars in the landed bronze shape (spaced ``Stock Splits`` variant)."""
    return bars.select(
        F.col("trade_date").cast("timestamp").alias("Date"),
        F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"), F.col("close_price").alias("Close"),
        F.col("volume").alias("Volume"), F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"), F.col("symbol").alias("ticker"))


def broken_bars(bars):
    """Bars as text with values broken by a rule on the day of month:
    day 28 no date, close 'x' on day 7, 'NaN' on day 13, missing on day 21,
    volume 'n/a' on day 3."""
    d = F.dayofmonth("trade_date")
    close = (F.when(d == 7, "x").when(d == 13, "NaN").when(d == 21, F.lit(None))
             .otherwise(F.col("close_price").cast("string")))
    return bars.select(
        F.col("symbol").alias("ticker"),
        F.when(d == 28, F.lit(None)).otherwise(F.col("trade_date").cast("timestamp")).alias("Date"),
        F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"), close.alias("Close"),
        F.when(d == 3, "n/a").otherwise(F.col("volume").cast("string")).alias("Volume"))


BROKEN_SQL = ("raw", """
    select symbol as ticker,
           case when day(trade_date) = 28 then null else cast(trade_date as timestamp) end as Date,
           open_price as Open, high_price as High, low_price as Low,
           case when day(trade_date) = 7 then 'x' when day(trade_date) = 13 then 'NaN'
                when day(trade_date) = 21 then null else cast(close_price as varchar) end as Close,
           case when day(trade_date) = 3 then 'n/a' else cast(volume as varchar) end as Volume
    from bars""")


def broken_series_rows(series):
    """Landed series text rows (code, data dd/MM/yyyy, valor, serie), broken
    by day of month: day 9 an impossible date, day 5 value 'x', day 17 no
    value, day 11 no series name."""
    d = F.dayofmonth("ref_date")
    return series.select(
        F.when(d == 9, F.lit("31/02/2001")).otherwise(F.date_format("ref_date", "dd/MM/yyyy")).alias("data"),
        F.when(d == 5, "x").when(d == 17, F.lit(None)).otherwise(F.col("idx_value").cast("string")).alias("valor"),
        F.when(d == 11, F.lit(None)).otherwise(F.col("idx_type")).alias("serie"))


BROKEN_SERIES_SQL = ("raw", """
    select case when day(ref_date) = 9 then '31/02/2001' else strftime(ref_date, '%d/%m/%Y') end as data,
           case when day(ref_date) = 5 then 'x' when day(ref_date) = 17 then null
                else cast(idx_value as varchar) end as valor,
           case when day(ref_date) = 11 then null else idx_type end as serie
    from series""")



def tolerant_sql(c: str) -> str:
    """DuckDB form of :func:`tickforge.functions.numeric.tolerant_double`."""
    return f"(case when isnan(try_cast({c} as double)) then null else try_cast({c} as double) end)"
