"""Registered queries that write, read back and compare: layer tables, quarantine, source reader, layouts, contracts."""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import clean, coverage, equity, layout, macro, profile, quality, silver
from tickforge.plans import medallion
from tickforge.plans.check_queries import BROKEN_SILVER_SQL, CHECKS, broken_silver
from tickforge.plans.fixtures import BROKEN_SQL, bronze_like
from tickforge.plans.flow_queries import RUN_TS
from tickforge.plans.registry import BARS, EQUITY_SQL, SERIES, _with, query, rounded
from tickforge.session import scratch_dir
from tickforge.sources import payload as pl
from tickforge.sources import quote_source
from tickforge.sources import tables as tb
from tickforge.streaming.month_table import MonthTable

CODES = {"R": 1178, "A": 433, "N": 99}
SERIES_JSON = '{"selic": 1178, "ipca": 433}'


@query("quality_quarantine", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL) + """
select symbol, trade_date, close_price, case when close_price is null or trade_date is null then 'quarantine' else 'good' end as part,
       concat_ws(',', case when close_price is null then 'valid_close' end,
                 case when trade_date is null then 'valid_date' end,
                 case when symbol is null then 'symbol_not_null' end) as failed
from s""", runs_jobs=True)
def q_quality_quarantine(spark, sf_dir):
    """Good and failing rows from one pass, each read back from its own part with the names of its failed checks."""
    rows = broken_silver(spark, sf_dir)
    path = os.path.join(scratch_dir(spark, "quarantine"), "rows")
    quality.write_split(rows, CHECKS, path)
    parts = [quality.read_split(rows.schema, spark, path, p).withColumn("part", F.lit(p)) for p in (quality.GOOD, quality.QUARANTINE)]
    out = parts[0].unionByName(parts[1])
    return rounded(out.select("symbol", "trade_date", "close_price", "part", F.array_join("failed_checks", ",").alias("failed")))


@query("quarantine_counts", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL) + """
select 'rows' as metric, count(*) as value from s
union all select 'quarantine', count(*) from s where close_price is null or trade_date is null or symbol is null
union all select 'failed valid_close', count(*) from s where close_price is null
union all select 'failed valid_date', count(*) from s where trade_date is null
union all select 'failed symbol_not_null', count(*) from s where symbol is null""", runs_jobs=True)
def q_quarantine_counts(spark, sf_dir):
    """The counts that the quarantine's write observes."""
    path = os.path.join(scratch_dir(spark, "quarantine"), "rows")
    counts = quality.write_split(broken_silver(spark, sf_dir), CHECKS, path)
    return spark.createDataFrame(sorted(counts.items()), "metric string, value long")


@query("source_reader", _with(BARS) + """
select symbol as ticker, cast(trade_date as timestamp) as trade_date, open_price as open, high_price as high, low_price as low,
       close_price as close, volume from bars where symbol in ('1-URGENT', '5-LOW')""", runs_jobs=True)
def q_source_reader(spark, sf_dir):
    """A landing of one folder a ticker through the data source: two tickers are asked for and read."""
    landing = os.path.join(scratch_dir(spark, "source"), "landing")
    docs = pl.bars_to_payloads(tb.bars(spark, sf_dir))
    docs.select(F.get("results", 0)["symbol"].alias("symbol"), "results").write.partitionBy("symbol").json(landing)
    quote_source.register(spark)
    rows = spark.read.format("quote_payloads").option("path", landing).load().filter(F.col("ticker").isin("1-URGENT", "5-LOW"))
    return rounded(rows.select("ticker", F.timestamp_seconds(F.col("epoch").cast("long")).alias("trade_date"),
                               "open", "high", "low", "close", "volume"))


@query("coverage_merged", """
select count(*) as rows, count(distinct o_custkey) as n_keys, cast(min(o_orderdate) as timestamp) as first_date,
       cast(max(o_orderdate) as timestamp) as last_date from orders""", runs_jobs=True)
def q_coverage_merged(spark, sf_dir):
    """Exact coverage from monthly states: orders up to 1999 first, then the rest with one month corrected."""
    orders = tb.read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("d"))
    root, month = scratch_dir(spark, "coverage"), F.date_format("d", "yyyy-MM")
    # The first load lacks the odd keys of one month; the second brings them.
    early = orders.filter((month < "2000-01") & ((month != "1997-07") | (F.col("k") % 2 == 0)))
    late = orders.filter((month >= "2000-01") | (month == "1997-07"))
    numbers, states = None, None
    for i, rows in enumerate((early, late)):
        path = os.path.join(root, f"numbers{i}")
        coverage.key_numbers(numbers, rows, "k").write.parquet(path)
        numbers = spark.read.parquet(path)
        new = coverage.coverage_states(rows, numbers, "k", "d")
        states = states or MonthTable(spark, os.path.join(root, "states"), "ref_month", new.schema)
        states.replace(new)
    return rounded(coverage.coverage_of_states(states.read()))


def _database(spark):
    """A database of its own for one run, in the shared scratch folder."""
    name = f"run_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'database')}'")
    return name


def bucketed_bars(spark, bars, buckets: int = 8):
    """Silver rows as a catalog table, bucketed and sorted by (symbol, month): a hot symbol is spread over its months."""
    spec, database = schemas.table_spec("prata", "tb_mkt_eqt_day"), _database(spark)
    rows = bars.withColumn("ref_month", F.date_trunc("month", "trade_date"))
    layout.write_table(rows, spec=spec, bucket_by=(buckets, ["symbol", "ref_month"]), database=database)
    return spark.table(spec.name_in(database))


@query("layout_bucketed", EQUITY_SQL, runs_jobs=True)
def q_layout_bucketed(spark, sf_dir):
    """Gold from a bucketed layer table: the lag and the month states need no exchange of rows."""
    table = bucketed_bars(spark, tb.bars(spark, sf_dir))
    return rounded(equity.performance_of_states(equity.month_states(table, segment="ref_month")))


@query("layout_in_files", _with(BARS) + """
select symbol, strftime(trade_date, '%Y-%m') as ref_month, count(*) as n_rows, cast(0 as bigint) as out_of_order,
       cast(1 as bigint) as files from bars group by 1, 2""", runs_jobs=True)
def q_layout_in_files(spark, sf_dir):
    """The physical order of a written table: in each file the rows ascend by symbol and date, and a symbol's month is in one file."""
    path = os.path.join(scratch_dir(spark, "layout"), "bars")
    layout.write_table(layout.partition_by_key(tb.bars(spark, sf_dir), "symbol", "trade_date"), path=path)
    rows = spark.read.parquet(path).select("symbol", "trade_date", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("place"))
    here = Window.partitionBy("file", "symbol", F.date_trunc("month", "trade_date")).orderBy("trade_date")
    rows = rows.withColumn("wrong", (F.col("place") < F.lag("place").over(here)).cast("int"))
    return rows.groupBy("symbol", F.date_format("trade_date", "yyyy-MM").alias("ref_month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("wrong"), F.lit(0)).cast("long").alias("out_of_order"),
        F.count_distinct("file").alias("files"))


def _landings(spark, sf_dir):
    """Landed payload files of all bars and landed series rows (one code is not asked for; day 9 has bad values)."""
    landing = os.path.join(scratch_dir(spark, "landing"), "quotes")
    pl.bars_to_payloads(tb.bars(spark, sf_dir), overlap_days=3).drop("segment").write.json(landing)
    code = F.create_map(*[x for k, v in CODES.items() for x in (F.lit(k), F.lit(v))])[F.col("idx_type")]
    series = tb.series(spark, sf_dir).select(
        code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
        F.when(F.dayofmonth("ref_date") == 9, "n/d").otherwise(F.col("idx_value").cast("string")).alias("valor"))
    return landing, series


def _refreshed(spark, sf_dir, out_root=None, databases=None):
    landing, series = _landings(spark, sf_dir)
    return medallion.refresh_layers(spark, landing, series, SERIES_JSON, out_root, "01/01/1990", "01/08/2001", as_of="2001-11-04",
                                    run_ts=RUN_TS, tickers=["1-URGENT", "2-high", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                                    databases=databases)


_KEPT_SERIES = ("kept", """select case idx_type when 'R' then 'selic' else 'ipca' end as serie, ref_date, idx_value from series
    where idx_type in ('R', 'A') and day(ref_date) <> 9""")


@query("written_layers", _with(BARS, SERIES, _KEPT_SERIES) + """
select 'bronze_quotes' as layer, count(*) as observed, count(*) as read_back, round(sum(close_price), 4) as total from bars
union all select 'silver_quotes', count(*), count(*), round(sum(close_price), 4) from bars
union all select 'bronze_series', count(*), count(*), round(sum(idx_value), 4) from kept
union all select 'silver_series', count(*), count(*), round(sum(idx_value), 4) from kept
union all select 'gold_equity', count(*), count(*), round(sum(p), 4) from (select avg(close_price) as p from bars group by symbol)
union all select 'gold_macro', count(*), count(*), round(sum(m), 4) from (
  select avg(idx_value) as m from kept group by serie, strftime(ref_date, '%Y-%m'))""", runs_jobs=True)
def q_written_layers(spark, sf_dir):
    """All six layer tables of a refresh, read back: rows as observed while writing, rows found, and the sum of a column."""
    root = os.path.join(scratch_dir(spark, "layers"), "out")
    got = _refreshed(spark, sf_dir, root)
    value = {"bronze_quotes": "Close", "silver_quotes": "close_price", "bronze_series": "valor", "silver_series": "idx_value",
             "gold_equity": "avg_price", "gold_macro": "media_mensal"}
    parts = [tb.read_layer(spark, name, os.path.join(root, name)).agg(
        F.lit(name).alias("layer"), F.lit(got[name]["rows"]).cast("long").alias("observed"), F.count(F.lit(1)).alias("read_back"),
        F.round(F.sum(column), 4).alias("total")) for name, column in value.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("written_bronze_quotes", _with(BARS) + """
select cast(trade_date as timestamp) as Date, open_price as Open, high_price as High, low_price as Low, close_price as Close,
       volume as Volume, cast(0.0 as double) as Dividends, cast(0.0 as double) as Stock_Splits, symbol as ticker,
       timestamp '2001-11-05 00:00:00' as ingestion_timestamp from bars""", runs_jobs=True)
def q_written_bronze_quotes(spark, sf_dir):
    """Bronze quotes as a refresh writes them, stamp included."""
    root = os.path.join(scratch_dir(spark, "layers"), "out")
    _refreshed(spark, sf_dir, root)
    return rounded(schemas.conform(tb.read_layer(spark, "bronze_quotes", os.path.join(root, "bronze_quotes")), schemas.BRONZE_QUOTES))


@query("written_gold_macro", _with(SERIES, _KEPT_SERIES, ("monthly", """
select serie as idx_type, cast(year(ref_date) as integer) as ano, cast(month(ref_date) as integer) as mes,
       strftime(ref_date, '%Y-%m') as ano_mes, avg(idx_value) as media_mensal, min(idx_value) as minimo_mensal,
       max(idx_value) as maximo_mensal, cast(min(ref_date) as timestamp) as primeira_data_mes,
       cast(max(ref_date) as timestamp) as ultima_data_mes, count(*) as num_medicoes from kept group by 1, 2, 3, 4"""), ("trend", """
select serie as k, regr_slope(idx_value, epoch(cast(ref_date as timestamp))) as s from kept
where ref_date >= date '2001-11-04' - interval 6 month group by 1""")) + """
select idx_type, ano, mes, ano_mes, round(media_mensal, 6) as media_mensal, round(minimo_mensal, 6) as minimo_mensal,
       round(maximo_mensal, 6) as maximo_mensal,
       round((media_mensal / nullif(lag(media_mensal) over (partition by idx_type order by ano, mes), 0) - 1) * 100, 6)
         as variacao_mes_anterior, primeira_data_mes, ultima_data_mes, num_medicoes,
       max(ultima_data_mes) over (partition by idx_type) as last_update, round(coalesce(s, 0), 12) as trend_6m
from monthly left join trend on k = idx_type""", runs_jobs=True)
def q_written_gold_macro(spark, sf_dir):
    """All 13 columns of the dashboard as a refresh writes them from landed text rows."""
    root = os.path.join(scratch_dir(spark, "layers"), "out")
    _refreshed(spark, sf_dir, root)
    return rounded(tb.read_layer(spark, "gold_macro", os.path.join(root, "gold_macro")), special={"trend_6m": 12})


@query("refresh_report", _with(BARS, SERIES, ("docs", """
select symbol, strftime(trade_date, '%Y-%m') as m from bars union
select symbol, strftime(date_trunc('month', trade_date) + interval 1 month, '%Y-%m') from bars
where cast(trade_date as date) + 3 >= date_trunc('month', trade_date) + interval 1 month""")) + """
select 'quote_documents' as report, 'ok' as item, count(*) as value from docs
union all select 'quote_sources ok', symbol, cast(1 as bigint) from bars group by symbol
union all select 'series_rows', case idx_type when 'R' then '1178' when 'A' then '433' else '99' end, count(*) from series group by idx_type
union all select 'series_dropped', case idx_type when 'R' then '1178' when 'A' then '433' else '99' end,
       count(*) filter (where day(ref_date) = 9) from series group by idx_type
union all select 'bronze_nulls', 'ticker_not_null', cast(0 as bigint) from (select count(*) from bars)""", runs_jobs=True)
def q_refresh_report(spark, sf_dir):
    """What a refresh says of its sources: documents by outcome, requested tickers, rows dropped a code, missing keys."""
    got = _refreshed(spark, sf_dir, os.path.join(scratch_dir(spark, "layers"), "out"))
    rows = [("quote_documents", k, v) for k, v in got["quote_documents"].items()]
    rows += [(f"quote_sources {v}", k, 1) for k, v in got["quote_sources"].items()]
    rows += [("series_rows", k, v[0]) for k, v in got["series_dropped"].items()]
    rows += [("series_dropped", k, v[1]) for k, v in got["series_dropped"].items()]
    rows += [("bronze_nulls", k, v) for k, v in got["bronze_nulls"]["bronze_quotes"].items() if k == "ticker_not_null"]
    return spark.createDataFrame(rows, "report string, item string, value long")


@query("catalog_tables", _with(BARS, SERIES, _KEPT_SERIES, ("m", """
select serie, strftime(ref_date, '%Y-%m') from kept group by 1, 2""")) + """
select 'cotacoes_b3' as table_name, 'Cotações brutas da B3 (Yahoo Finance)' as comment, 'bronze' as quality, count(*) as n_rows from bars
union all select 'series_bacen', 'Séries temporais do BACEN (SGS)', 'bronze', count(*) from kept
union all select 'tb_mkt_eqt_day', 'Série histórica diária de equity', 'silver', count(*) from bars
union all select 'tb_mkt_idx_eco', 'Indicadores econômicos padronizados', 'silver', count(*) from kept
union all select 'tb_mkt_eqt_perf', 'Análise de performance de equity', 'gold', count(distinct symbol) from bars
union all select 'tb_mkt_idx_dash', 'Dashboard de indicadores macroeconômicos', 'gold', count(*) from m""", runs_jobs=True)
def q_catalog_tables(spark, sf_dir):
    """The catalog tables of a refresh: their names, comments and quality labels as the catalog has them, and their rows."""
    databases = {layer: _database(spark) for layer in schemas.TABLES}
    _refreshed(spark, sf_dir, databases=databases)
    out = None
    for layer, tables in schemas.TABLES.items():
        for key in tables:
            name = schemas.table_name(layer, key, database=databases[layer])
            props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            comment = spark.catalog.getTable(name).description or props.get("comment")
            row = spark.table(name).agg(F.lit(schemas.table_name(layer, key, with_schema=False)).alias("table_name"),
                                        F.lit(comment).alias("comment"), F.lit(props["quality"]).alias("quality"),
                                        F.count(F.lit(1)).alias("n_rows"))
            out = row if out is None else out.unionByName(row)
    return out


@query("contract_columns", _with(BARS) + """
select column_name, required, filled from (
  select unnest(['trade_date', 'open_price', 'high_price', 'low_price', 'close_price', 'volume', 'div_cash', 'split_ratio', 'symbol',
                 'ingestion_timestamp']) as column_name, true as required, n as filled from (select count(*) as n from bars))
union all select 'Date', false, cast(0 as bigint) from (select count(*) from bars)""")
def q_contract_columns(spark, sf_dir):
    """Silver against its contract: every required column with its values, and a bronze name that silver must not have."""
    bronze = clean.stamp_ingestion(clean.rename_spaced(bronze_like(tb.bars(spark, sf_dir))), RUN_TS)
    out = schemas.require_columns(silver.silver_equity(bronze), schemas.SILVER_EQUITY)
    info = profile.column_info(out).select("column_name", F.lit(True).alias("required"), F.col("non_null").alias("filled"))
    absent = schemas.missing_columns(out, ["Date", "symbol"])
    return info.unionByName(spark.createDataFrame([(c, False, 0) for c in absent], info.schema))


@query("contract_nulls", _with(BARS, BROKEN_SQL) + """
select 'Date_not_null' as check_name, count(Date) as passed, count(*) - count(Date) as failed from raw
union all select 'ticker_not_null', count(ticker), count(*) - count(ticker) from raw
union all select 'ingestion_timestamp_not_null', count(*), cast(0 as bigint) from raw""")
def q_contract_nulls(spark, sf_dir):
    """The non-null contract of bronze on rows of which some have no date."""
    from tickforge.plans.fixtures import broken_bars
    rows = clean.stamp_ingestion(broken_bars(tb.bars(spark, sf_dir)), RUN_TS)
    return quality.check_report(rows, quality.not_null_checks(schemas.BRONZE_QUOTES)).withColumnRenamed("check", "check_name")


@query("ingestion_stamp", _with(BARS) + """
select symbol, cast(trade_date as timestamp) as trade_date, timestamp '2001-11-05 00:00:00' as ingestion_timestamp,
       cast(0.0 as double) as div_cash from bars""")
def q_ingestion_stamp(spark, sf_dir):
    """One instant for all rows of a run, kept through to silver."""
    bronze = clean.stamp_ingestion(clean.rename_spaced(bronze_like(tb.bars(spark, sf_dir))), RUN_TS)
    return rounded(silver.silver_equity(bronze).select("symbol", "trade_date", "ingestion_timestamp", "div_cash"))


@query("empty_layers", _with(BARS) + """
select cast(trade_date as timestamp) as trade_date, open_price, high_price, low_price, close_price, volume,
       cast(null as double) as div_cash, cast(null as double) as split_ratio, symbol, cast(null as timestamp) as ingestion_timestamp
from bars""")
def q_empty_layers(spark, sf_dir):
    """A layer that failed to build is an empty table of its schema: stacked with rows it adds none and gives the columns."""
    empty = medallion.bronze_quotes(spark, os.path.join(scratch_dir(spark, "none"), "missing"), "01/01/2001", "01/08/2001",
                                    on_error="empty")
    silver_empty = silver.silver_equity(empty)
    bars = tb.bars(spark, sf_dir).withColumn("trade_date", F.col("trade_date").cast("timestamp"))
    return rounded(silver_empty.unionByName(bars, allowMissingColumns=True).select(*schemas.SILVER_EQUITY.fieldNames()))


@query("quote_window_default", _with(BARS) + """
select symbol as ticker, cast(trade_date as timestamp) as Date, close_price as Close from bars
where trade_date between timestamp '2001-05-01' and timestamp '2001-08-01'""")
def q_quote_window_default(spark, sf_dir):
    """The default span of a quote request: the last three calendar months up to a day."""
    start, end = medallion.quote_window(_dt.date(2001, 8, 1))
    return rounded(clean.date_window(bronze_like(tb.bars(spark, sf_dir)), start, end).select("ticker", "Date", "Close"))


@query("macro_today", _with(SERIES, ("moved", """
select idx_type, idx_value, cast(ref_date as date) + cast(date_diff('day', cast((select max(ref_date) from series) as date), current_date) as integer) as d from series""")) + """
select idx_type, round(arg_max(idx_value, d), 6) as current_value,
       round((arg_max(idx_value, d) filter (where d >= date_trunc('month', current_date))
              / arg_min(idx_value, d) filter (where d >= date_trunc('month', current_date)) - 1) * 100, 6) as mtd_change,
       count(*) filter (where d >= current_date - interval 6 month) as recent
from moved group by 1""")
def q_macro_today(spark, sf_dir):
    """The summary of today, on the series moved so that its last day is today."""
    s = tb.series(spark, sf_dir)
    last = s.agg(F.max("ref_date").cast("date")).first()[0]  # one day
    moved = s.select("idx_type", "idx_value", F.date_add(F.col("ref_date").cast("date"), F.datediff(F.current_date(), F.lit(last)))
                     .alias("ref_date"))
    summary = macro.macro_summary(moved).select("idx_type", "current_value", "mtd_change")
    recent = moved.groupBy(F.col("idx_type").alias("k")).agg(
        F.count_if(F.col("ref_date") >= F.add_months(macro.as_of_col(None), -6)).alias("recent"))
    return rounded(summary.join(recent, F.col("idx_type") == F.col("k")).drop("k"))


@query("sorted_rows", _with(BARS) + """
select symbol, cast(trade_date as timestamp) as trade_date, close_price,
       row_number() over (order by symbol, trade_date) - 1 as place from bars""", runs_jobs=True)
def q_sorted_rows(spark, sf_dir):
    """The global order of sorted rows, as the place of each row in the written files."""
    path = os.path.join(scratch_dir(spark, "sorted"), "rows")
    rows = profile.sorted_rows(tb.bars(spark, sf_dir), ["symbol", "trade_date"]).select("symbol", "trade_date", "close_price")
    rows.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    # One row a written partition.
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("part").alias("p"), "first", before.alias("before"))
    out = rows.join(F.broadcast(sizes), F.col("part") == F.col("p"))
    return rounded(out.select("symbol", "trade_date", "close_price", (F.col("before") + F.col("at") - F.col("first")).alias("place")))


_SKEWED = "case when o_orderkey % 3 = 0 then 1.0 else o_totalprice * pow(2.0, (o_orderkey % 41) - 30) * case when o_orderkey % 5 = 0 then -1 else 1 end end"


@query("describe_skewed", f"""
select o_orderpriority as symbol, 'value' as column_name, count(*) as count, round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as q25,
       round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, round(max(v), 6) as max
from (select o_orderpriority, {_SKEWED} as v from orders) group by 1""", runs_jobs=True)
def q_describe_skewed(spark, sf_dir):
    """Exact quantiles of values of which a third are equal and the others spread over many powers of two and both signs."""
    v = F.when(F.col("o_orderkey") % 3 == 0, 1.0).otherwise(
        F.col("o_totalprice") * F.pow(F.lit(2.0), (F.col("o_orderkey") % 41) - 30) * F.when(F.col("o_orderkey") % 5 == 0, -1).otherwise(1))
    rows = tb.read_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), v.alias("value"))
    return rounded(profile.describe(rows, ["value"], by="symbol", final_rows=100).drop("mean", "std"))
