"""Registered queries: intraday returns, payload outcomes, layer chains."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from tickforge.operators import equity, macro, profile, quality
from tickforge.plans import medallion
from tickforge.plans.registry import (BARS, EQUITY_SQL, EVENT_BARS, SERIES, _equity_sql, _with,
                                     query, rounded)
from tickforge.sources import payload as pl
from tickforge.sources import tables as tb

# Fixed parameters: the run stamp of the registered layer chains.
RUN_TS = _dt.datetime(2001, 11, 5)


@query("intraday_return", _with(EVENT_BARS) + """
select symbol, trade_date, close_price, prev_close,
       round(close_price / nullif(prev_close, 0) - 1, 6) as daily_return
from (select symbol, trade_date, close_price,
             lag(close_price) over (partition by symbol order by trade_date) as prev_close
      from bars)""")
def q_intraday_return(spark, sf_dir):
    """Tick-to-tick return on intraday rows, lagged inside (key, day)."""
    out = equity.daily_returns(tb.event_bars(spark, sf_dir), segment="day")
    return rounded(out.select("symbol", "trade_date", "close_price", "prev_close", "daily_return"))


def _damaged_docs(bars):
    """Payload documents per (symbol, month) with their landing key; by rule
    on the month number, month 2 loses its history and month 11 its results."""
    docs = pl.bars_to_payloads(bars)
    m = F.substring("segment", 6, 2).cast("int")
    first = F.get(F.col("results"), 0)
    hist_type = first["historicalDataPrice"]
    no_hist = F.array(F.struct(first["symbol"].alias("symbol"),
                               F.filter(hist_type, lambda x: F.lit(False)).alias("historicalDataPrice")))
    no_results = F.filter(F.col("results"), lambda x: F.lit(False))
    results = F.when(m == 11, no_results).when(m == 2, no_hist).otherwise(F.col("results"))
    return docs.select(first["symbol"].alias("landing_key"), "segment", results.alias("results"))


@query("payload_status", _with(BARS) + """
select symbol as ticker,
       case when month(trade_date) = 11 then 'no_results'
            when month(trade_date) = 2 then 'no_history' else 'ok' end as outcome,
       count(distinct strftime(trade_date, '%Y-%m')) as documents,
       cast(sum(case when month(trade_date) in (2, 11) then 0 else 1 end) as bigint) as bars
from bars group by 1, 2""")
def q_payload_status(spark, sf_dir):
    """Per ticker and outcome: documents and bars. A document without
    results carries no symbol; its landing key names it (as a file name)."""
    docs = _damaged_docs(tb.bars(spark, sf_dir))
    per_doc = pl.payload_outcome(docs, F.coalesce(pl.payload_ticker(), F.col("landing_key")))
    return per_doc.groupBy("ticker", "outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_bars").cast("bigint").alias("bars"))


@query("rows_of_series", _with(SERIES) + "select * from series where idx_type = 'A'")
def q_rows_of_series(spark, sf_dir):
    return rounded(profile.rows_of(tb.series(spark, sf_dir), "idx_type", "A"))


@query("bronze_series", _with(SERIES) + """
select strptime(l.data, '%d/%m/%Y') as data, cast(l.valor as double) as valor,
       coalesce(m.serie, cast(l.code as varchar)) as serie
from (select case idx_type when 'R' then 1178 when 'A' then 433 else 12 end as code,
             strftime(ref_date, '%d/%m/%Y') as data, cast(idx_value as varchar) as valor
      from series) l
left join (values ('selic', 1178), ('ipca', 433)) m(serie, code) on l.code = m.code""")
def q_bronze_series(spark, sf_dir):
    s = tb.series(spark, sf_dir)
    code = F.when(F.col("idx_type") == "R", 1178).when(F.col("idx_type") == "A", 433).otherwise(12)
    landed = s.select(code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
                      F.col("idx_value").cast("string").alias("valor"))
    out = medallion.bronze_series(spark, landed, '{"selic": 1178, "ipca": 433}', RUN_TS)
    return rounded(out.drop("ingestion_timestamp"))


@query("layers_equity", EQUITY_SQL)
def q_layers_equity(spark, sf_dir):
    """Payload documents -> bronze -> silver (checked) -> gold, one plan."""
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir))
    text = docs.select(F.to_json(F.struct("results")).alias("body"))
    bronze = medallion.bronze_quotes(spark, pl.parse_payload_text(text), "01/01/1990", "01/08/2001",
                                     max_days=None, run_ts=RUN_TS)
    gold = medallion.gold_equity(medallion.silver_quotes(bronze, mode="drop"))
    return rounded(gold)


@query("latest_per_key", _with(BARS) + """
select symbol as ticker, cast(trade_date as timestamp) as Date,
       case when day(trade_date) = 15 then close_price * 2 else close_price end as Close,
       case when day(trade_date) = 15 then timestamp '2001-11-06 00:00:00'
            else timestamp '2001-11-05 00:00:00' end as ingestion_timestamp
from bars""")
def q_latest_per_key(spark, sf_dir):
    """Bronze landed twice: the full history, then corrections for the 15th
    of each month (close doubled, exact in binary; later stamp). Compaction
    keeps the latest."""
    from tickforge.operators.layout import latest_per_key
    bars = tb.bars(spark, sf_dir)
    first = bars.select(F.col("symbol").alias("ticker"), F.col("trade_date").cast("timestamp").alias("Date"),
                        F.col("close_price").alias("Close"),
                        F.lit(RUN_TS).cast("timestamp").alias("ingestion_timestamp"))
    fix = (first.filter(F.dayofmonth("Date") == 15)
           .withColumn("Close", F.col("Close") * 2)
           .withColumn("ingestion_timestamp", F.lit(RUN_TS + _dt.timedelta(days=1)).cast("timestamp")))
    return rounded(latest_per_key(first.unionByName(fix), ["ticker", "Date"]))


def gappy_bars(bars):
    """Bars with a zero close on the 13th and a missing close on the 21st of
    each month (unparseable prices kept NULL, ``null_fill=None``)."""
    d = F.dayofmonth("trade_date")
    close = F.when(d == 13, F.lit(0.0)).when(d == 21, F.lit(None).cast("double")) \
             .otherwise(F.col("close_price"))
    return bars.withColumn("close_price", close)


@query("equity_perf_gaps", _equity_sql(("bars0", tb.BARS_SQL), ("bars", """
    select symbol, trade_date,
           case when day(trade_date) = 13 then 0.0 when day(trade_date) = 21 then null
                else close_price end as close_price, volume
    from bars0""")))
def q_equity_perf_gaps(spark, sf_dir):
    """Zero closes make the next return x/0 (NULL, not an error) and the
    zero day's own return -1; missing closes give NULL returns on both sides."""
    return rounded(equity.equity_performance(gappy_bars(tb.bars(spark, sf_dir))))


@query("layers_equity_overlap", EQUITY_SQL)
def q_layers_equity_overlap(spark, sf_dir):
    """The chain on landings that overlap: every document repeats the last 5 days of the month
    before, so bars land twice and must count once."""
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir), overlap_days=5)
    text = docs.select(F.to_json(F.struct("results")).alias("body"))
    bronze = medallion.bronze_quotes(spark, pl.parse_payload_text(text), "01/01/1990", "01/08/2001", run_ts=RUN_TS)
    return rounded(medallion.gold_equity(medallion.silver_quotes(bronze, mode="drop")))


# Codes of the landed series: two are named by the map, one is not and must not become a series.
_CODES = {"R": 1178, "A": 433, "N": 99}
SPAN = ("01/01/1995", "31/12/2000")


@query("layers_macro", _with(SERIES, ("kept", """
    select case idx_type when 'R' then 'selic' else 'ipca' end as idx_type, ref_date, idx_value from series
    where idx_type in ('R', 'A') and ref_date between date '1995-01-01' and date '2000-12-31'
      and day(ref_date) <> 9""")) + """
select * exclude (m), max(ultima_data_mes) over (partition by idx_type) as last_update, cast(0 as double) as trend_6m,
       round((m / nullif(lag(m) over (partition by idx_type order by ano, mes), 0) - 1) * 100, 6) as variacao_mes_anterior
from (select idx_type, cast(year(ref_date) as integer) as ano, cast(month(ref_date) as integer) as mes,
             strftime(ref_date, '%Y-%m') as ano_mes, round(avg(idx_value), 6) as media_mensal, avg(idx_value) as m,
             round(min(idx_value), 6) as minimo_mensal, round(max(idx_value), 6) as maximo_mensal,
             count(*) as num_medicoes, cast(min(ref_date) as timestamp) as primeira_data_mes,
             cast(max(ref_date) as timestamp) as ultima_data_mes
      from kept group by 1, 2, 3, 4)""")
def q_layers_macro(spark, sf_dir):
    """Landed text rows -> bronze (requested codes and span, bad values of day 9 dropped) -> silver -> gold: all columns
    of the dashboard (no row lies in the trend's six months, so the trend is 0)."""
    s = tb.series(spark, sf_dir)
    code = F.create_map(*[x for k, v in _CODES.items() for x in (F.lit(k), F.lit(v))])[F.col("idx_type")]
    landed = s.select(code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
                      F.when(F.dayofmonth("ref_date") == 9, "n/d").otherwise(F.col("idx_value").cast("string")).alias("valor"))
    bronze = medallion.bronze_series(spark, landed, '{"selic": 1178, "ipca": 433}', RUN_TS, start=SPAN[0], end=SPAN[1],
                                     known_only=True)
    return rounded(medallion.gold_macro(medallion.silver_series(bronze), as_of="2001-11-04", sort=False))


PAST = "1998-06-15"


@query("macro_summary_past", _with(SERIES, ("known", f"select * from series where ref_date <= date '{PAST}'")) + f"""
select idx_type, round(arg_max(idx_value, ref_date), 6) as current_value,
       round((arg_max(idx_value, ref_date) filter (where ref_date >= date '1998-06-01')
              / arg_min(idx_value, ref_date) filter (where ref_date >= date '1998-06-01') - 1) * 100, 6) as mtd_change,
       round((arg_max(idx_value, ref_date) filter (where ref_date >= date '1998-01-01')
              / arg_min(idx_value, ref_date) filter (where ref_date >= date '1998-01-01') - 1) * 100, 6) as ytd_change,
       cast(max(ref_date) as timestamp) as last_update,
       round(coalesce(regr_slope(idx_value, epoch(cast(ref_date as timestamp))) filter (where ref_date >= date '1997-12-15'), 0), 12)
         as trend_6m
from known group by idx_type""")
def q_macro_summary_past(spark, sf_dir):
    """The summary of a day in the middle of the data reads nothing after that day."""
    out = macro.macro_summary(tb.series(spark, sf_dir), as_of=PAST)
    return rounded(out.withColumn("last_update", F.col("last_update").cast("timestamp")), special={"trend_6m": 12})


@query("macro_dashboard_past", _with(SERIES, ("known", f"select * from series where ref_date <= date '{PAST}'")) + f"""
select idx_type, strftime(ref_date, '%Y-%m') as ano_mes, round(avg(idx_value), 6) as media_mensal,
       count(*) as num_medicoes, cast(max(max(ref_date)) over (partition by idx_type) as timestamp) as last_update,
       round(max(slope) , 12) as trend_6m
from known join (select idx_type as k, regr_slope(idx_value, epoch(cast(ref_date as timestamp))) as slope from known
                 where ref_date >= date '1997-12-15' group by 1) on k = idx_type
group by 1, 2""")
def q_macro_dashboard_past(spark, sf_dir):
    out = macro.macro_dashboard(tb.series(spark, sf_dir), as_of=PAST, sort=False)
    out = out.withColumn("last_update", F.col("last_update").cast("timestamp"))
    return rounded(out.select("idx_type", "ano_mes", "media_mensal", "num_medicoes", "last_update", "trend_6m"),
                   special={"trend_6m": 12})


@query("source_outcome", _with(BARS, ("docs", """
    select symbol, strftime(trade_date, '%Y-%m') as segment, min(month(trade_date)) as m, count(*) as n
    from bars group by 1, 2"""), ("req", """
    select distinct symbol from bars union all select distinct n_name from nation""")) + """
select symbol, documents, malformed, no_results, no_history, rows_total,
       case when rows_total > 0 then 'ok' when documents = 0 then 'no_data' when malformed = documents then 'malformed'
            when no_history > 0 then 'no_history' else 'no_data' end as status
from (select r.symbol, count(d.segment) as documents,
             count(*) filter (where k = 'malformed') as malformed, count(*) filter (where k = 'no_results') as no_results,
             count(*) filter (where k = 'no_history') as no_history,
             cast(coalesce(sum(case when k = 'ok' then n end), 0) as bigint) as rows_total
      from req r left join (select *, case when symbol = '2-HIGH' then 'malformed'
                                           when symbol = '3-MEDIUM' then case when m % 2 = 0 then 'no_results' else 'no_history' end
                                           when m = 11 then 'malformed' when m = 2 then 'no_history'
                                           else 'ok' end as k from docs) d on d.symbol = r.symbol
      group by 1)""")
def q_source_outcome(spark, sf_dir):
    """One status a requested key: symbols whose documents are all broken, or empty in two ways,
    symbols with some good documents, and requested names for which nothing landed."""
    bars = tb.bars(spark, sf_dir)
    docs = pl.bars_to_payloads(bars).withColumn("key", F.get("results", 0)["symbol"])
    m = F.substring("segment", 6, 2).cast("int")
    kind = (F.when(F.col("key") == "2-HIGH", "malformed")
            .when(F.col("key") == "3-MEDIUM", F.when(m % 2 == 0, "no_results").otherwise("no_history"))
            .when(m == 11, "malformed").when(m == 2, "no_history").otherwise("ok"))
    body = (F.when(kind == "malformed", F.lit('{"results": [{"symbol'))
            .when(kind == "no_results", F.lit('{"results": []}'))
            .when(kind == "no_history", F.lit('{"results": [{"historicalDataPrice": []}]}'))
            .otherwise(F.to_json(F.struct("results"))))
    payloads = pl.parse_payload_text(docs.select("key", body.alias("body")))
    label = F.coalesce(pl.payload_ticker(), F.col("key"))  # as a landed file's name would say
    nation = tb.read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("symbol"))
    requested = bars.select("symbol").distinct().union(nation)
    out = quality.source_outcome(requested, pl.payload_outcome(payloads, label), pl.quote_rows(payloads, label))
    return out.select("symbol", "documents", "malformed", "no_results", "no_history", "rows_total", "status")


_NULLS_SQL = """select case when day(trade_date) = 13 then null else symbol end as k, close_price as close_price,
       cast(null as double) as nothing, case when symbol = '5-LOW' then null else volume end as volume from bars"""


@query("describe_nulls", _with(BARS, ("t", _NULLS_SQL)) + " union all ".join(f"""
select k, '{c}' as column_name, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
       round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50,
       round(quantile_cont({c}, 0.75), 6) as q75, round(max({c}), 6) as max from t group by k"""
       for c in ("close_price", "nothing", "volume")))
def q_describe_nulls(spark, sf_dir):
    """A column without values, a key without values in one column, and a NULL key are all reported."""
    b = tb.bars(spark, sf_dir)
    t = b.select(F.when(F.dayofmonth("trade_date") != 13, F.col("symbol")).alias("k"), "close_price",
                 F.lit(None).cast("double").alias("nothing"),
                 F.when(F.col("symbol") != "5-LOW", F.col("volume")).alias("volume"))
    return rounded(profile.describe(t, by="k"))
