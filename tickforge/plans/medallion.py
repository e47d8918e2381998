"""The layer chain as pure functions: landing -> bronze -> silver -> gold.

Each table function takes and returns a DataFrame, so they chain with
``DataFrame.transform`` and run as one Catalyst plan per written table.
"""

from __future__ import annotations

import datetime as _dt
import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.functions.dates import BR_DATE
from tickforge.functions.text import normalise_ticker
from tickforge.operators import clean, equity, layout, macro, quality, silver
from tickforge.sources import payload as pl
from tickforge.sources import series as sr
from tickforge.session import remove, written

log = logging.getLogger(__name__)

# Rows of a report that a refresh returns; the whole report is a table.
REPORT_ROWS = 1000


# Document columns that tell which landing of a bar is the later one.
SOURCE_COLUMNS = ("source_time", "source_file")


def quote_bars(payloads: DataFrame, null_fill: float | None = 0.0, run_ts: _dt.datetime | None = None,
               start: str | None = None, end: str | None = None, max_days: int | None = None,
               tickers: DataFrame | None = None) -> DataFrame:
    """Payload documents -> labelled, cleaned, stamped bars; the one path that
    batch and incremental ingestion share. Keeps :data:`SOURCE_COLUMNS` where
    the documents have them. Overlapping landings are not compacted here.
    """
    return clean_bars(pl.quote_rows(payloads, _label(payloads), SOURCE_COLUMNS), null_fill, run_ts, start, end, max_days, tickers)


def _label(payloads: DataFrame):
    """The payload's symbol, else the name of its file."""
    if "source_file" not in payloads.columns:
        return pl.payload_ticker()
    return F.coalesce(pl.payload_ticker(), pl.ticker_from_file("source_file"))


def clean_bars(rows: DataFrame, null_fill: float | None = 0.0, run_ts: _dt.datetime | None = None,
               start: str | None = None, end: str | None = None, max_days: int | None = None,
               tickers: DataFrame | None = None) -> DataFrame:
    """Raw bars -> bars of the wanted tickers and span, cleaned and stamped."""
    if tickers is not None:
        rows = rows.join(tickers.select(F.col("symbol").alias("ticker")), "ticker", "left_semi")
    if start is not None or end is not None:
        rows = clean.date_window(rows, start, end, "Date", max_days, BR_DATE)
    rows = clean.clean_quotes(rows, null_fill=null_fill)
    return clean.stamp_ingestion(rows, run_ts)


def compact_quotes(bars: DataFrame) -> DataFrame:
    """One row per (ticker, Date): the latest ingestion, then the later landed
    file. Fetches overlap by design, so every bar lands several times."""
    order = ["ingestion_timestamp", *[c for c in SOURCE_COLUMNS if c in bars.columns]]
    return schemas.conform(layout.latest_per_key(bars, ["ticker", "Date"], order), schemas.BRONZE_QUOTES)


def _or_empty(spark, schema, on_error, what, build):
    """``on_error="empty"`` turns a failure into an empty table, and says so."""
    try:
        return build()
    except Exception:
        if on_error != "empty":
            raise
        log.exception("%s could not be built; going on with an empty table", what)
        return schemas.empty_frame(spark, schema)


def bronze_quotes(spark: SparkSession, landing: str | DataFrame, start: str, end: str,
                  max_days: int | None = None, run_ts: _dt.datetime | None = None,
                  null_fill: float | None = 0.0, on_error: str = "raise",
                  tickers: DataFrame | None = None, multi_line: bool = False) -> DataFrame:
    """Landed payloads -> bronze quotes (typed, windowed, stamped, one row a bar).

    ``landing`` is a folder of payload files, or a DataFrame of parsed
    payload documents (``results`` column, e.g. from ``parse_payload_text``).
    ``max_days`` (default: none) cuts the span to its last days.
    """
    def build():
        payloads = landing if isinstance(landing, DataFrame) else \
            pl.read_quote_payloads(spark, landing, multi_line)
        rows = quote_bars(payloads, null_fill, run_ts, start, end, max_days, tickers)
        schemas.require_columns(rows, schemas.BRONZE_QUOTES)
        return compact_quotes(rows)
    return _or_empty(spark, schemas.BRONZE_QUOTES, on_error, "bronze quotes", build)


def bronze_series(spark: SparkSession, landed: DataFrame, series_json: str,
                  run_ts: _dt.datetime | None = None, date_fmt: str = BR_DATE,
                  on_error: str = "raise", start: str | None = None,
                  end: str | None = None, known_only: bool = False) -> DataFrame:
    """Landed series rows (code, data text, valor text) -> bronze series.

    ``start`` / ``end`` (``dd/MM/yyyy``, inclusive) bound the dates kept, as
    the requested span bounds a fetch; None keeps everything landed.
    ``known_only`` drops codes that the map does not name (a request never
    asks for them).
    """
    def build():
        named = sr.series_map(spark, series_json)
        rows = landed
        if known_only:
            rows = rows.join(named.select("code"), "code", "left_semi")
        rows = sr.label_series(rows, named, known_size=sr.map_size(series_json))
        rows = clean.clean_series(rows, date_fmt=date_fmt)
        if start is not None:
            rows = rows.filter(F.col("data") >= F.to_timestamp(F.lit(start), date_fmt))
        if end is not None:
            rows = rows.filter(F.col("data") <= F.to_timestamp(F.lit(end), date_fmt))
        rows = clean.stamp_ingestion(rows.select("data", "valor", "serie"), run_ts)
        return schemas.conform(rows, schemas.BRONZE_SERIES)
    return _or_empty(spark, schemas.BRONZE_SERIES, on_error, "bronze series", build)


def silver_quotes(bronze: DataFrame, mode: str = "warn", observation=None) -> DataFrame:
    out = silver.silver_equity(bronze)
    return quality.apply_checks(out, quality.SILVER_EQUITY_CHECKS, mode, observation)


def silver_series(bronze: DataFrame, frequency="D") -> DataFrame:
    return silver.silver_macro(bronze, frequency)


def gold_equity(silver_quotes_df: DataFrame, segment: str = "month") -> DataFrame:
    """``segment``: "month" for daily bars, "auto" (or "day", "hour") for denser rows."""
    return equity.equity_performance(silver_quotes_df, segment=segment)


def gold_macro(silver_series_df: DataFrame, as_of=None, sort: bool = True) -> DataFrame:
    return macro.macro_dashboard(silver_series_df, as_of=as_of, sort=sort)


def quote_window(as_of: _dt.date | None = None, months: int = 3) -> tuple[str, str]:
    """Default quote span: the last ``months`` calendar months up to ``as_of``
    (today when None), as ``dd/MM/yyyy`` text. Scalar config, driver side."""
    end = as_of or _dt.datetime.now(_dt.timezone.utc).date()
    y, m = divmod(end.month - 1 - months, 12)
    start_month = _dt.date(end.year + y, m + 1, 1)
    # Same day of month, clipped to the month's length (like add_months).
    nxt = _dt.date(start_month.year + (start_month.month == 12), start_month.month % 12 + 1, 1)
    start = start_month.replace(day=min(end.day, (nxt - _dt.timedelta(days=1)).day))
    return start.strftime("%d/%m/%Y"), end.strftime("%d/%m/%Y")


def refresh_layers(spark: SparkSession, quotes_landing: str, series_landed: DataFrame,
                   series_json: str, out_root: str | None, start: str, end: str,
                   as_of=None, max_days: int | None = None, check_mode: str = "warn",
                   run_ts: _dt.datetime | None = None, tickers: list[str] | None = None,
                   series_start: str | None = None, series_end: str | None = None,
                   null_fill: float | None = 0.0, multi_line: bool = False,
                   databases: dict[str, str] | None = None) -> dict:
    """Build and write the six layer tables: parquet folders under ``out_root``,
    or catalog tables (with comments and properties) when that is None.

    The landings are read once: what they hold (bars, and the outcome of every document;
    series rows as they came) is written to the shared scratch folder, and bronze as well as the reports
    are made from that. Each write is one Spark job whose row count (for bronze also the non-null
    contract, for silver quotes the check failures) is observed while writing. Silver and gold read the
    written layer below them, so a lost executor only reruns the last step.
    Silver is partitioned by month, so month-to-date, year-to-date and trend
    read only their months. Returns ``{table: observed metrics}``; what the
    sources lost is in ``quote_documents`` (documents per outcome),
    ``quote_sources`` (one status a requested ticker), ``series_dropped``
    (rows in, rows dropped a landed code; written whole as the table ``report_series``, of
    which the first :data:`REPORT_ROWS` codes are returned) and ``bronze_nulls`` (non-null contract).
    """
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    specs = {"bronze_quotes": ("bronze", "cotacoes_b3"), "bronze_series": ("bronze", "series_bacen"),
             "silver_quotes": ("prata", "tb_mkt_eqt_day"), "silver_series": ("prata", "tb_mkt_idx_eco"),
             "gold_equity": ("ouro", "tb_mkt_eqt_perf"), "gold_macro": ("ouro", "tb_mkt_idx_dash")}
    obs: dict[str, Observation] = {}

    def write(name: str, df: DataFrame, by: list[str] | None = None) -> None:
        spec = schemas.table_spec(*specs[name])
        path = None if out_root is None else os.path.join(out_root, name)
        obs[name] = layout.write_table(df, None if path else spec, path, partition_by=by,
                                       database=(databases or {}).get(spec.layer))

    def read(name: str) -> DataFrame:
        if out_root is not None:
            return spark.read.parquet(os.path.join(out_root, name))
        spec = schemas.table_spec(*specs[name])
        return spark.table(spec.name_in((databases or {}).get(spec.layer)))

    wanted = None
    if tickers is not None:
        wanted = spark.createDataFrame([(t,) for t in tickers], "symbol string").select(
            normalise_ticker("symbol").alias("symbol")).distinct()
    payloads = pl.read_quote_payloads(spark, quotes_landing, multi_line)
    landed_quotes = written(pl.landed_rows(payloads, _label(payloads), SOURCE_COLUMNS), "landed-quotes")
    bars = landed_quotes.filter("bar is not null").drop("outcome", "bar")
    bars = clean_bars(bars, null_fill, run_ts, start, end, max_days, wanted)
    schemas.require_columns(bars, schemas.BRONZE_QUOTES)
    nulls = {}

    def keyed(name: str, df: DataFrame, schema) -> DataFrame:
        nulls[name] = Observation(f"{name}_nulls")
        return quality.apply_checks(df, quality.not_null_checks(schema), "warn", nulls[name])

    bq = keyed("bronze_quotes", compact_quotes(bars), schemas.BRONZE_QUOTES)
    write("bronze_quotes", layout.partition_by_key(bq, "ticker", "Date"))
    landed_series = written(series_landed.select("code", "data", "valor"), "landed-series")
    bs = bronze_series(spark, landed_series, series_json, run_ts, start=series_start, end=series_end,
                       known_only=True)
    bs = keyed("bronze_series", bs, schemas.BRONZE_SERIES)
    write("bronze_series", layout.partition_by_key(bs, "serie", "data"))

    checks = Observation("silver_quotes_checks")
    month = lambda c: F.date_format(F.date_trunc("month", F.col(c)), "yyyy-MM")
    sq = silver_quotes(read("bronze_quotes"), check_mode, checks).withColumn("ref_month", month("trade_date"))
    write("silver_quotes", layout.partition_by_key(sq, "ref_month", "trade_date"), ["ref_month"])
    if check_mode == "warn":  # the check metrics are observed only in warn mode
        obs["silver_quotes_checks"] = checks
    ss = silver_series(read("bronze_series")).withColumn("ref_month", month("ref_date"))
    write("silver_series", layout.partition_by_key(ss, "ref_month", "ref_date"), ["ref_month"])
    write("gold_equity", gold_equity(read("silver_quotes").drop("ref_month")))
    write("gold_macro", gold_macro(read("silver_series").drop("ref_month"), as_of, sort=False))

    out = {k: v.get for k, v in obs.items()}
    per_doc = landed_quotes.filter("bar is null or bar = 0").select("ticker", "outcome")
    # At most one row an outcome, and one a requested ticker.
    out["quote_documents"] = {r["outcome"]: r["n"] for r in
                              per_doc.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    if wanted is not None:
        status = quality.source_outcome(wanted, per_doc, read("bronze_quotes"))
        out["quote_sources"] = {r["symbol"]: r["status"] for r in status.collect()}
    dropped = clean.dropped_per_series(landed_series, serie="code", date_fmt=BR_DATE)
    if out_root is None:
        bronze_db = schemas.table_spec("bronze", "series_bacen").name_in((databases or {}).get("bronze")).split(".")[0]
        dropped.write.mode("overwrite").saveAsTable(f"{bronze_db}.report_series")
        report = spark.table(f"{bronze_db}.report_series")
    else:
        dropped.write.mode("overwrite").parquet(os.path.join(out_root, "report_series"))
        report = spark.read.parquet(os.path.join(out_root, "report_series"))
    out["series_dropped"] = {str(r["code"]): [r["rows_in"], r["rows_dropped"]]
                             for r in report.orderBy("code").limit(REPORT_ROWS).collect()}
    out["bronze_nulls"] = {name: {k: v for k, v in seen.get.items() if k != "rows"} for name, seen in nulls.items()}
    remove(landed_quotes)
    remove(landed_series)
    return out
