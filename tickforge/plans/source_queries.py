"""Registered queries: sources, cleaning, silver, payloads, incremental."""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import functions as F

from tickforge.functions.dates import reformat_date_text
from tickforge.functions.text import normalise_ticker
from tickforge.operators import clean, layout, silver
from tickforge.plans.registry import BARS, SERIES, _with, query, rounded
from tickforge.session import scratch_dir
from tickforge.sources import config as cfg
from tickforge.sources import payload as pl
from tickforge.sources import series as sr
from tickforge.sources import tables as tb
from tickforge.streaming.commits import CommitLog
from tickforge.streaming.incremental import compact_increments, incremental_quotes, ingestion_report
from tickforge.plans.fixtures import (  # noqa: F401
    BROKEN_SERIES_SQL, BROKEN_SQL, broken_bars, broken_series_rows, bronze_like,
    tolerant_sql as _tolerant_sql)

# Fixed parameters of the registered queries.
RUN_TS = _dt.datetime(2001, 11, 5)
WINDOW_START, WINDOW_END = "01/01/2001", "01/08/2001"
SERIES_MAP_JSON = '{"selic": 1178, "ipca": 433}'


@query("silver_equity", _with(BARS) + """
select cast(trade_date as timestamp) as trade_date, open_price, high_price, low_price, close_price,
       volume, cast(0.0 as double) as div_cash, cast(0.0 as double) as split_ratio, symbol
from bars""")
def q_silver_equity(spark, sf_dir):
    bronze = clean.stamp_ingestion(clean.rename_spaced(bronze_like(tb.bars(spark, sf_dir))))
    return rounded(silver.silver_equity(bronze).drop("ingestion_timestamp"))


@query("silver_macro", _with(SERIES) + """
select cast(ref_date as timestamp) as ref_date, idx_value, idx_type, 'D' as frequency from series""")
def q_silver_macro(spark, sf_dir):
    s = tb.series(spark, sf_dir)
    bronze = s.select(F.col("ref_date").cast("timestamp").alias("data"),
                      F.col("idx_value").alias("valor"), F.col("idx_type").alias("serie"))
    return rounded(silver.silver_macro(bronze))


@query("parse_payload", _with(BARS) + """
select cast(trade_date as timestamp) as Date, open_price as Open, high_price as High,
       low_price as Low, close_price as Close, volume as Volume, cast(0.0 as double) as Dividends,
       cast(0.0 as double) as Stock_Splits, symbol as ticker
from bars""")
def q_parse_payload(spark, sf_dir):
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir))
    text = docs.select(F.to_json(F.struct("results")).alias("body"))
    return rounded(pl.quote_rows(pl.parse_payload_text(text)))


@query("date_window", _with(BARS) + """
select symbol as ticker, cast(trade_date as timestamp) as Date, close_price as Close
from bars
where cast(trade_date as timestamp) >= cast(greatest(date '2001-01-01', date '2001-08-01' - interval 90 day) as timestamp)
  and cast(trade_date as timestamp) <= timestamp '2001-08-01 00:00:00'""")
def q_date_window(spark, sf_dir):
    rows = bronze_like(tb.bars(spark, sf_dir))
    out = clean.date_window(rows, WINDOW_START, WINDOW_END, "Date", max_days=90)
    return rounded(out.select("ticker", "Date", "Close"))


@query("clean_quotes", _with(BARS, BROKEN_SQL) + f"""
select ticker, Date, Open, High, Low,
       coalesce({_tolerant_sql('Close')}, 0.0) as Close,
       coalesce({_tolerant_sql('Volume')}, 0.0) as Volume,
       cast(0.0 as double) as Dividends, cast(0.0 as double) as Stock_Splits
from raw where Date is not null""")
def q_clean_quotes(spark, sf_dir):
    raw = broken_bars(tb.bars(spark, sf_dir)).withColumns(
        {"Dividends": F.lit(0.0), "Stock_Splits": F.lit(0.0)})
    return rounded(clean.clean_quotes(raw))


@query("clean_series", _with(SERIES, BROKEN_SERIES_SQL) + f"""
select try_strptime(data, '%d/%m/%Y') as data, {_tolerant_sql('valor')} as valor,
       coalesce(serie, 'NA') as serie
from raw
where try_strptime(data, '%d/%m/%Y') is not null and {_tolerant_sql('valor')} is not null""")
def q_clean_series(spark, sf_dir):
    raw = broken_series_rows(tb.series(spark, sf_dir))
    return rounded(clean.clean_series(raw, date_fmt="d/M/yyyy"))


@query("clean_series_dropped", _with(SERIES, BROKEN_SERIES_SQL) + f"""
select serie, count(*) as rows_in,
       count(*) filter (where try_strptime(data, '%d/%m/%Y') is null or {_tolerant_sql('valor')} is null)
         as rows_dropped
from raw group by serie""")
def q_clean_series_dropped(spark, sf_dir):
    raw = broken_series_rows(tb.series(spark, sf_dir))
    return clean.dropped_per_series(raw, date_fmt="d/M/yyyy")


@query("ticker_normalise", """
select c_custkey, cast(pos as bigint) as pos, upper(replace(trim(item), '.SA', '')) as ticker
from (select c_custkey, unnest(l) as item, unnest(range(0, len(l))) as pos
      from (select c_custkey,
                   string_split(lower(c_mktsegment) || '.SA, ,' || c_mktsegment || '.sa ,', ',') as l
            from customer))
where trim(item) <> ''""")
def q_ticker_normalise(spark, sf_dir):
    cust = tb.read_table(spark, sf_dir, "customer")
    text = F.concat(F.lower("c_mktsegment"), F.lit(".SA, ,"), F.col("c_mktsegment"), F.lit(".sa ,"))
    rows = cfg.explode_list(cust.select("c_custkey", text.alias("txt")), "txt")
    return rows.select("c_custkey", F.col("pos").cast("bigint").alias("pos"),
                       normalise_ticker("item").alias("ticker"))


@query("series_map", _with(SERIES) + """
select l.code, coalesce(m.serie, cast(l.code as varchar)) as serie,
       strptime(l.data, '%d/%m/%Y') as data, cast(l.valor as double) as valor
from (select case idx_type when 'R' then 1178 when 'A' then 433 else 12 end as code,
             strftime(ref_date, '%d/%m/%Y') as data, cast(idx_value as varchar) as valor
      from series) l
left join (values ('selic', 1178), ('ipca', 433)) m(serie, code) on l.code = m.code""")
def q_series_map(spark, sf_dir):
    s = tb.series(spark, sf_dir)
    code = F.when(F.col("idx_type") == "R", 1178).when(F.col("idx_type") == "A", 433).otherwise(12)
    landed = s.select(code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
                      F.col("idx_value").cast("string").alias("valor"))
    out = sr.label_series(sr.typed_series(landed), sr.series_map(spark, SERIES_MAP_JSON),
                          known_size=sr.map_size(SERIES_MAP_JSON))
    return rounded(out.select("code", "serie", "data", "valor"))


@query("date_reformat", """
select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as date_br, strftime(o_orderdate, '%Y-%m-%d') as date_iso
from orders""")
def q_date_reformat(spark, sf_dir):
    o = tb.read_table(spark, sf_dir, "orders")
    br = o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_br"))
    return br.withColumn("date_iso", reformat_date_text("date_br", strict=True))


@query("series_wide", _with(SERIES) + """
select ref_date, max(idx_value) filter (where idx_type = 'A') as A,
       max(idx_value) filter (where idx_type = 'N') as N,
       max(idx_value) filter (where idx_type = 'R') as R
from series group by ref_date""")
def q_series_wide(spark, sf_dir):
    return rounded(sr.series_wide(tb.series(spark, sf_dir), ["A", "N", "R"]))


@query("series_stack", _with(SERIES) + """select idx_type, ref_date, idx_value from series
union all select idx_type || '_x2', ref_date, round(idx_value * 2, 6) from series""")
def q_series_stack(spark, sf_dir):
    """Two frames, the series and their doubles, stacked by name whatever their column order."""
    s = tb.series(spark, sf_dir)
    twice = s.select((F.col("idx_value") * 2).alias("idx_value"), "ref_date",
                     F.concat("idx_type", F.lit("_x2")).alias("idx_type"))
    return rounded(sr.stack([s, twice]))


@query("partition_layout", _with(BARS) + "select * from bars")
def q_partition_layout(spark, sf_dir):
    return rounded(layout.partition_by_key(tb.bars(spark, sf_dir), "symbol", "trade_date"))


def _tolerant_docs(bars):
    """Payload text per (symbol, month) as careless services write it: prices quoted, epochs with a
    decimal point, closes of day 7 'x', of day 13 'NaN' and of day 21 missing."""
    d = F.dayofmonth("trade_date")
    close = F.when(d == 7, "x").when(d == 13, "NaN").when(d != 21, F.col("close_price").cast("string"))
    point = F.struct(F.unix_timestamp(F.col("trade_date").cast("timestamp")).cast("double").alias("date"),
                     F.col("open_price").cast("string").alias("open"), F.col("high_price").alias("high"),
                     F.col("low_price").cast("string").alias("low"), close.alias("close"),
                     F.col("volume").cast("string").alias("volume"))
    docs = bars.groupBy("symbol", F.date_trunc("month", "trade_date").alias("m")).agg(
        F.collect_list(point).alias("historicalDataPrice"))
    return docs.select(F.to_json(F.struct(F.array(F.struct("symbol", "historicalDataPrice")).alias("results"))).alias("body"))


@query("parse_payload_tolerant", _with(BARS) + """
select cast(trade_date as timestamp) as Date, open_price as Open, high_price as High,
       low_price as Low, case when day(trade_date) in (7, 13, 21) then null else close_price end as Close,
       volume as Volume, cast(0.0 as double) as Dividends, cast(0.0 as double) as Stock_Splits, symbol as ticker
from bars""")
def q_parse_payload_tolerant(spark, sf_dir):
    return rounded(pl.quote_rows(pl.parse_payload_text(_tolerant_docs(tb.bars(spark, sf_dir)))))


INCREMENTAL_SQL = _with(BARS) + """
select cast(trade_date as timestamp) as Date, open_price as Open, high_price as High,
       low_price as Low, close_price as Close, volume as Volume, cast(0.0 as double) as Dividends,
       cast(0.0 as double) as Stock_Splits, symbol as ticker
from bars"""


def _landed(docs, folder, name):
    docs.select("results").write.mode("overwrite").json(os.path.join(folder, name))


@query("incremental_bars", INCREMENTAL_SQL, runs_jobs=True)
def q_incremental_bars(spark, sf_dir):
    """Two refreshes through the streaming path: months up to 1998, then the
    rest, each document repeating the previous month's last 5 days. The
    second run must take only the new files and keep one of the repeated bars."""
    root = scratch_dir(spark, "incremental")
    landing, sink, ckpt = (os.path.join(root, p) for p in ("landing", "sink", "checkpoint"))
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir), overlap_days=5)
    for i, cond in enumerate([F.col("segment") <= "1998-12", F.col("segment") > "1998-12"]):
        _landed(docs.filter(cond), landing, f"run{i}")
        out = incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt)
    return rounded(out.drop("ingestion_timestamp"))


@query("incremental_late", INCREMENTAL_SQL, runs_jobs=True)
def q_incremental_late(spark, sf_dir):
    """Run 1 lands all symbols but one, with wrong closes (doubled) in the last month of every
    year. Run 2 lands a symbol that is new, with its whole history, and corrections of all
    those months, long after newer bars. Nothing may be lost, and the later landing wins."""
    root = scratch_dir(spark, "incremental")
    landing, sink, ckpt = (os.path.join(root, p) for p in ("landing", "sink", "checkpoint"))
    bars = tb.bars(spark, sf_dir)
    december = F.month("trade_date") == 12
    wrong = bars.withColumn("close_price", F.when(december, F.col("close_price") * 2).otherwise(F.col("close_price")))
    new = F.col("symbol") == "1-URGENT"
    runs = [pl.bars_to_payloads(wrong.filter(~new)), pl.bars_to_payloads(bars.filter(new | december))]
    for i, docs in enumerate(runs):
        _landed(docs, landing, f"run{i}")
        out = incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=2,
                                 run_ts=RUN_TS + _dt.timedelta(days=i))
    return rounded(out.drop("ingestion_timestamp"))


def forget_last_commit(spark, checkpoint):
    """Leave a stream's checkpoint as a crash between a batch's write and its end leaves it: the batch runs again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint, "commits"))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().isdigit()]
    fs.delete(max(done, key=lambda p: int(p.getName())), False)


def _two_landings(spark, sf_dir):
    """Landings up to 1998 and after, each month repeating the last 5 days of the one before."""
    root = scratch_dir(spark, "incremental")
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir), overlap_days=5)
    parts = [docs.filter(F.col("segment") <= "1998-12"), docs.filter(F.col("segment") > "1998-12")]
    return [os.path.join(root, p) for p in ("landing", "sink", "checkpoint")] + [parts]


@query("incremental_compacted", INCREMENTAL_SQL, runs_jobs=True)
def q_incremental_compacted(spark, sf_dir):
    """Land, ingest, lose the end of the last batch, compact, land more, ingest (the last batch runs again), compact,
    remove what was replaced, lose and repeat the last batch once more: every bar is there, once."""
    landing, sink, ckpt, (early, late) = _two_landings(spark, sf_dir)
    _landed(early, landing, "run0")
    incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=3)
    forget_last_commit(spark, ckpt)
    compact_increments(spark, sink)
    _landed(late, landing, "run1")
    incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt)
    compact_increments(spark, sink)
    CommitLog(spark, sink).remove_replaced()
    forget_last_commit(spark, ckpt)
    out = incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt)
    return rounded(out.drop("ingestion_timestamp"))


@query("incremental_report", _with(BARS, ("months", """
select symbol, strftime(trade_date, '%Y-%m') as m, count(*) as n from bars group by 1, 2"""), ("tails", """
select symbol, strftime(date_trunc('month', trade_date) + interval 1 month, '%Y-%m') as m, count(*) as n from bars
where cast(trade_date as date) + 5 >= date_trunc('month', trade_date) + interval 1 month group by 1, 2"""), ("docs", """
select m, sum(n) as n from (select * from months union all select * from tails) group by symbol, m""")) + """
select cast(m > '1998-12' as int) as run, count(*) as documents, count(*) as ok, cast(sum(n) as bigint) as bars,
       cast(0 as bigint) as malformed from docs group by 1""", runs_jobs=True)
def q_incremental_report(spark, sf_dir):
    """What every run took in, as counted while it was written: documents, their outcomes and bars."""
    landing, sink, ckpt, parts = _two_landings(spark, sf_dir)
    runs, known = [], spark.createDataFrame([], "commit string")
    for i, docs in enumerate(parts):
        _landed(docs, landing, f"run{i}")
        incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=4)
        report = ingestion_report(spark, sink)
        runs.append(report.join(known, "commit", "left_anti").withColumn("run", F.lit(i)))
        known = report.select("commit").distinct()
    both = runs[0].unionByName(runs[1])
    return both.groupBy("run").agg(*[F.sum(F.when(F.col("metric") == m, F.col("value"))).alias(m)
                                     for m in ("documents", "ok", "bars", "malformed")])
