"""Quote payloads (one JSON document per ticker and request) -> bronze rows.

Landed files are read with an explicit schema (no inference pass); each
document's ``results[0].historicalDataPrice`` array is exploded on the
executors, so the work is spread over files and documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.numeric import tolerant_double
from tickforge.functions.text import normalise_ticker

BAR_FIELDS = ["open", "high", "low", "close", "volume"]

# Numbers are read as text: a service may quote them, or write an epoch as
# 1704153600.0, and a typed read would turn those into NULL.
PRICE_POINT = T.StructType([
    T.StructField("date", T.StringType()),
    *[T.StructField(f, T.StringType()) for f in BAR_FIELDS],
])

QUOTE_PAYLOAD = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("symbol", T.StringType()),
        T.StructField("historicalDataPrice", T.ArrayType(PRICE_POINT)),
    ]))),
    # Filled with the raw text when a document is not valid JSON.
    T.StructField("_corrupt_record", T.StringType()),
])

# Bronze quote columns, in contract order.
BRONZE_QUOTE_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume", "Dividends",
                        "Stock_Splits", "ticker"]


def with_source(payloads: DataFrame) -> DataFrame:
    """Keep the landed file's name (for labels) and time (the later file wins)."""
    return (payloads.withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("source_time", F.col("_metadata.file_modification_time")))


def read_quote_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed payload files with their names: JSON lines, or (``multi_line``) one
    document a file over any number of lines."""
    return with_source(
        spark.read.schema(QUOTE_PAYLOAD).option("multiLine", multi_line)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def ticker_from_file(path_col: str = "source_file") -> Column:
    """Ticker from a landed file name such as ``.../PETR4.json`` (NULL when
    the name carries none)."""
    name = F.regexp_extract(
        F.col(path_col), r"([^/]+?)(\.(json|jsonl|ndjson))?(\.(gz|bz2|zst|zstd|lz4|snappy|deflate))?$", 1)
    return F.when(F.col(path_col).isNull() | name.startswith("part-") | (name == ""), F.lit(None)) \
            .otherwise(name)


def payload_ticker() -> Column:
    """The payload's own ``symbol`` field (combine with :func:`ticker_from_file`)."""
    first = F.get(F.col("results"), 0)
    return first.getField("symbol")


def parse_payload_text(df: DataFrame, text_col: str = "body") -> DataFrame:
    """A column of JSON text -> the payload struct columns."""
    parsed = F.from_json(F.col(text_col), QUOTE_PAYLOAD,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("__p", parsed).select("*", "__p.*").drop("__p")


def _bar_columns() -> list[Column]:
    """The bar ``__b`` as the columns of a bronze row."""
    epoch = tolerant_double(F.col("__b.date"))
    # Outside the range of timestamps it is no date (and the cast would fail).
    epoch = F.when(F.abs(epoch) < 1e11, epoch.cast("bigint"))
    return [F.timestamp_seconds(epoch).alias("Date"),
            *[tolerant_double(F.col(f"__b.{f}")).alias(f.capitalize()) for f in BAR_FIELDS],
            F.lit(0.0).alias("Dividends"), F.lit(0.0).alias("Stock_Splits")]


def quote_rows(payloads: DataFrame, ticker: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload documents -> one row per bar (bronze column contract, then the
    document columns named in ``keep``).

    The ticker is the requested one when ``ticker`` is given, else the
    payload's ``symbol`` field, normalised (suffix dropped, upper case).
    """
    label = ticker if ticker is not None else payload_ticker()
    kept = [c for c in keep if c in payloads.columns]
    docs = payloads.select(normalise_ticker(label).alias("ticker"), _history().alias("__hist"), *kept)
    bars = docs.select("ticker", F.explode("__hist").alias("__b"), *kept)
    return bars.select(*_bar_columns(), "ticker", *kept)


def landed_rows(payloads: DataFrame, ticker: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """All that a landing holds, in one pass: the rows of :func:`quote_rows`, one row for each document without bars,
    and the document's ``outcome`` and ``bar`` (the bar's place in its document, NULL for a document without bars).

    So bars (``bar`` is not null) and documents (``bar`` is null or 0) can both be read from one written table.
    """
    label = ticker if ticker is not None else payload_ticker()
    kept = [c for c in keep if c in payloads.columns]
    docs = payloads.select(normalise_ticker(label).alias("ticker"), outcome_of(payloads).alias("outcome"),
                           _history().alias("__hist"), *kept)
    rows = docs.select("ticker", "outcome", F.posexplode_outer("__hist").alias("bar", "__b"), *kept)
    return rows.select(*_bar_columns(), "ticker", "outcome", "bar", *kept)


# The structural outcomes of a document.
OUTCOMES = ("malformed", "no_results", "no_history", "ok")


def _history() -> Column:
    return F.get(F.col("results"), 0).getField("historicalDataPrice")


def outcome_of(payloads: DataFrame) -> Column:
    """The structural outcome of a document, one of :data:`OUTCOMES`."""
    malformed = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in payloads.columns else F.lit(False)
    # Null-safe sizes: with ANSI off Spark's legacy size(NULL) is -1.
    n_results = F.when(F.col("results").isNull(), F.lit(0)).otherwise(F.size("results"))
    n_bars = F.when(_history().isNull(), F.lit(0)).otherwise(F.size(_history()))
    return (F.when(malformed, OUTCOMES[0]).when(n_results == 0, OUTCOMES[1]).when(n_bars == 0, OUTCOMES[2])
            .otherwise(OUTCOMES[3]))


def payload_outcome(payloads: DataFrame, ticker: Column | None = None) -> DataFrame:
    """Per document: ticker, number of bars and the structural outcome (:func:`outcome_of`)."""
    label = ticker if ticker is not None else payload_ticker()
    n_bars = F.when(_history().isNull(), F.lit(0)).otherwise(F.size(_history()))
    return payloads.select(normalise_ticker(label).alias("ticker"), outcome_of(payloads).alias("outcome"),
                           n_bars.alias("n_bars"))


def bars_to_payloads(bars: DataFrame, key: str = "symbol", date: str = "trade_date",
                     segment_fmt: str = "yyyy-MM", overlap_days: int = 0) -> DataFrame:
    """Silver-shaped bars -> payload documents, one per key and month (the
    size of one API request window, so a document never holds a whole key).
    ``overlap_days`` repeats the last days of the previous month at the head
    of each document, as overlapping refresh windows do."""
    d = F.col(date).cast("timestamp")
    point = F.struct(
        F.unix_timestamp(d).alias("date"),
        F.col("open_price").alias("open"), F.col("high_price").alias("high"),
        F.col("low_price").alias("low"), F.col("close_price").alias("close"),
        F.col("volume").alias("volume"),
    )
    rows = bars.withColumn("__seg", F.date_format(d, segment_fmt)).withColumn("__pt", point)
    if overlap_days:
        nxt = F.date_format(F.add_months(F.trunc(d, "MM"), 1), segment_fmt)
        tail = (rows.filter(F.date_add(d.cast("date"), overlap_days) >=
                            F.add_months(F.trunc(d, "MM"), 1))
                .withColumn("__seg", nxt))
        rows = rows.unionByName(tail)
    docs = rows.groupBy(key, "__seg").agg(
        F.array_sort(F.collect_list("__pt")).alias("historicalDataPrice"))
    return docs.select(
        F.col("__seg").alias("segment"),
        F.array(F.struct(F.col(key).alias("symbol"), "historicalDataPrice")).alias("results"))
