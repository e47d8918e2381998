"""Registered queries: lag by ranges, gold from month states, replaced months."""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import functions as F

from tickforge.operators import equity
from tickforge.plans.flow_queries import RUN_TS
from tickforge.plans.gold_states import QuoteLayer, SeriesLayer, update_quotes
from tickforge.plans.registry import (BARS, EQUITY_SQL, EVENT_BARS, ORACLES, SERIES_AS_OF, _monthly_ints, _with, query, rounded)
from tickforge.session import scratch_dir
from tickforge.sources import payload as pl
from tickforge.sources import tables as tb


@query("daily_return_dense", _with(EVENT_BARS) + """
select symbol, trade_date, close_price, prev_close,
       round(close_price / nullif(prev_close, 0) - 1, 6) as daily_return
from (select symbol, trade_date, close_price,
             lag(close_price) over (partition by symbol order by trade_date) as prev_close
      from bars)""", runs_jobs=True)
def q_daily_return_dense(spark, sf_dir):
    """Returns on rows of any density: ranges of rows, no window over a key or a span of time."""
    out = equity.daily_returns(tb.event_bars(spark, sf_dir), method="ranged")
    return rounded(out.select("symbol", "trade_date", "close_price", "prev_close", "daily_return"))


def _corrected_layer(layer, rows, value: str, wrong_month: str, later: str):
    """First load: all rows before the month ``later``, one month wrong (doubled). Then a refresh with that month as it
    should be, and the months from ``later`` on: only these months are read and written."""
    month = F.date_format(layer.date, "yyyy-MM")
    wrong = rows.withColumn(value, F.when(month == wrong_month, F.col(value) * 2).otherwise(F.col(value)))
    layer.refresh(wrong.filter(month < later))
    layer.refresh(rows.filter((month == wrong_month) | (month >= later)))
    return layer


@query("gold_incremental", EQUITY_SQL, runs_jobs=True)
def q_gold_incremental(spark, sf_dir):
    """Gold from stored month states after a correction and new months equals gold from all rows."""
    bars = tb.bars(spark, sf_dir)
    layer = QuoteLayer(spark, scratch_dir(spark, "gold-quotes"), bars)
    return rounded(_corrected_layer(layer, bars, "close_price", "1996-03", "2000-01").gold())


@query("gold_macro_incremental", ORACLES["macro_dashboard"], runs_jobs=True)
def q_gold_macro_incremental(spark, sf_dir):
    """The dashboard from stored month states and the rows of two months equals the one from all rows."""
    series = tb.series(spark, sf_dir)
    layer = SeriesLayer(spark, scratch_dir(spark, "gold-series"), series)
    layer = _corrected_layer(layer, series, "idx_value", "1996-03", "2000-01")
    out = layer.gold(_dt.date.fromisoformat(SERIES_AS_OF))
    return rounded(_monthly_ints(out), special={"trend_6m": 12})


@query("month_replaced", _with(BARS) + """
select strftime(trade_date, '%Y-%m') as ref_month, cast(count(*) as bigint) as n_rows, round(sum(close_price), 6) as total,
       case when strftime(trade_date, '%Y-%m') = '1997-05' then 2 else 1 end as version
from bars where strftime(trade_date, '%Y-%m') <> '1998-01' group by 1""", runs_jobs=True)
def q_month_replaced(spark, sf_dir):
    """One month is written again and one is emptied: both at once, and every other month keeps its files."""
    from tickforge.streaming.month_table import MonthTable
    bars = tb.bars(spark, sf_dir)
    month = F.date_format("trade_date", "yyyy-MM")
    table = MonthTable(spark, scratch_dir(spark, "months"), "trade_date", bars.schema)
    table.replace(bars.withColumn("close_price", F.when(month == "1997-05", F.lit(0.0)).otherwise(F.col("close_price"))))
    before = table.parts()
    table.replace(bars.filter(month == "1997-05"), ["1997-05", "1998-01"])
    after = table.parts()
    version = spark.createDataFrame([(m, 1 if before[m] == f else 2) for m, f in after.items()], "m string, version int")
    out = table.read().groupBy(month.alias("ref_month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("close_price").alias("total"))
    return rounded(out.join(F.broadcast(version), F.col("ref_month") == F.col("m")).drop("m"))


@query("update_quotes", EQUITY_SQL, runs_jobs=True)
def q_update_quotes(spark, sf_dir):
    """Three updates from landed files: the history with a wrong month, a correction of that month with new months, and nothing.

    Gold after them equals gold of all bars; the second touches only its months, the third none."""
    root = scratch_dir(spark, "update")
    landing, bars = os.path.join(root, "landing"), tb.bars(spark, sf_dir)
    month = F.date_format("trade_date", "yyyy-MM")
    wrong = bars.withColumn("close_price", F.when(month == "1996-03", F.col("close_price") * 2).otherwise(F.col("close_price")))
    runs = [wrong.filter(month < "2000-01"), bars.filter((month == "1996-03") | (month >= "2000-01"))]
    for i, rows in enumerate(runs):
        pl.bars_to_payloads(rows).drop("segment").write.json(os.path.join(landing, f"run{i}"))
        update_quotes(spark, os.path.join(landing, "*"), root, run_ts=RUN_TS + _dt.timedelta(days=i))
    last = update_quotes(spark, os.path.join(landing, "*"), root)
    if last["months"] or last["ingested"]:
        raise AssertionError("an update without new files touched something")
    return rounded(spark.read.parquet(os.path.join(root, "gold_equity")))
