"""Table readers: upstream layer tables and the mapping of the shared test
tables onto the bar / series shapes the operators expect."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_layer(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Batch read of an upstream layer: a catalog table, or a parquet folder."""
    return spark.read.parquet(path) if path else spark.table(name)


def _day(c: str):
    """The day of a zone-less timestamp, kept as a timestamp at midnight (the
    silver layer types trade / reference dates as timestamps)."""
    return F.to_date(F.col(c)).cast("timestamp_ntz")


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Daily bars: symbol = order priority, one bar per priority and day.

    open / close = total price of the lowest / highest order key of the day,
    high / low = max / min, volume = order count. Two-phase aggregate.
    """
    return (orders
            .groupBy(F.col("o_orderpriority").alias("symbol"),
                     _day("o_orderdate").alias("trade_date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open_price"),
                 F.max("o_totalprice").alias("high_price"),
                 F.min("o_totalprice").alias("low_price"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close_price"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def series_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Daily indicator values: idx_type = return flag, value = quantity sum."""
    return (lineitem
            .groupBy(F.col("l_returnflag").alias("idx_type"),
                     _day("l_shipdate").alias("ref_date"))
            .agg(F.sum("l_quantity").alias("idx_value")))


def bars_from_events(events: DataFrame) -> DataFrame:
    """Intraday 'bars' from events: symbol = event type, close = value."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("trade_date"),
        F.col("value").alias("close_price"),
        F.lit(1.0).alias("volume"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_orders(read_table(spark, sf_dir, "orders"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_events(read_table(spark, sf_dir, "events"))


# DuckDB forms of the same mappings, for oracle SQL.
BARS_SQL = """
select o_orderpriority as symbol, cast(cast(o_orderdate as date) as timestamp) as trade_date,
       arg_min(o_totalprice, o_orderkey) as open_price,
       max(o_totalprice) as high_price, min(o_totalprice) as low_price,
       arg_max(o_totalprice, o_orderkey) as close_price,
       cast(count(*) as double) as volume
from orders group by 1, 2
"""

SERIES_SQL = """
select l_returnflag as idx_type, cast(cast(l_shipdate as date) as timestamp) as ref_date,
       sum(l_quantity) as idx_value
from lineitem group by 1, 2
"""

EVENT_BARS_SQL = """
select event_type as symbol, ts as trade_date, value as close_price,
       cast(1 as double) as volume
from events
"""
