"""Registered queries over the shared test tables, each with a DuckDB oracle.

Each query maps the test tables onto quotes / indicator series
(see :mod:`tickforge.sources.tables`) and runs one library operator over the
whole tables. Floating results are rounded to 6 decimals on both sides
(Spark and DuckDB differ in the last digits of averages and moments); the
per-second slope is rounded to 12 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators import equity, macro
from tickforge.sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed parameter of the registered macro queries: the last date of the series.
SERIES_AS_OF = "2001-11-04"


# Queries that write tables or run streams when they are called: their plan is only that of the last read.
RUNS_JOBS: set[str] = set()


def query(name: str, sql: str | None = None, runs_jobs: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if runs_jobs:
            RUNS_JOBS.add(name)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, special: dict | None = None) -> DataFrame:
    """Comparable form: round every double column (``special`` gives
    per-column digits) and present instants as zone-less timestamps (the
    session zone is UTC, so the wall-clock value is unchanged)."""
    special = special or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(c, special.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(c.cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def _with(*ctes: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{n} as ({s})" for n, s in ctes)


BARS = ("bars", tb.BARS_SQL)
SERIES = ("series", tb.SERIES_SQL)
EVENT_BARS = ("bars", tb.EVENT_BARS_SQL)


# ---------------------------------------------------------------- equity ---

def _equity_sql(*bars_ctes) -> str:
    """Gold equity in SQL over a ``bars`` CTE (given last in ``bars_ctes``)."""
    return _with(*bars_ctes, ("r", """
        select symbol, trade_date, close_price, volume,
               close_price / nullif(lag(close_price) over (partition by symbol order by trade_date), 0) - 1 as ret
        from bars"""), ("m", """
        select symbol, strftime(trade_date, '%Y-%m') as ano_mes, avg(ret) as monthly_return
        from r group by 1, 2"""), ("a", """
        select symbol, avg(monthly_return) as avg_return, stddev_samp(monthly_return) as volatility
        from m group by 1"""), ("s", """
        select symbol, avg(close_price) as avg_price, avg(volume) as avg_volume,
               max(trade_date) as last_update
        from bars group by 1""")) + """
    select a.symbol, round(avg_return, 6) as avg_return, round(volatility, 6) as volatility,
           round(avg_price, 6) as avg_price, round(avg_volume, 6) as avg_volume, last_update
    from a join s on a.symbol = s.symbol"""


EQUITY_SQL = _equity_sql(BARS)


@query("equity_perf", EQUITY_SQL)
def q_equity_perf(spark, sf_dir):
    return rounded(equity.equity_performance(tb.bars(spark, sf_dir)))


@query("equity_perf_two_pass", EQUITY_SQL)
def q_equity_perf_two_pass(spark, sf_dir):
    return rounded(equity.equity_performance(tb.bars(spark, sf_dir), method="two_pass"))


@query("equity_perf_single_month", _equity_sql(EVENT_BARS))
def q_equity_perf_single_month(spark, sf_dir):
    # Intraday rows: day segments keep each window task to one key-day.
    return rounded(equity.equity_performance(tb.event_bars(spark, sf_dir), segment="day"))


DAILY_RETURN_SQL = _with(BARS) + """
select symbol, trade_date, close_price, prev_close,
       round(close_price / nullif(prev_close, 0) - 1, 6) as daily_return
from (select symbol, trade_date, close_price,
             lag(close_price) over (partition by symbol order by trade_date) as prev_close
      from bars)"""


@query("daily_return", DAILY_RETURN_SQL)
def q_daily_return(spark, sf_dir):
    out = equity.daily_returns(tb.bars(spark, sf_dir))
    return rounded(out.select("symbol", "trade_date", "close_price", "prev_close", "daily_return"))


@query("monthly_return", _with(BARS) + """
select symbol, ano_mes, round(avg(ret), 6) as monthly_return
from (select symbol, strftime(trade_date, '%Y-%m') as ano_mes,
             close_price / nullif(lag(close_price) over (partition by symbol order by trade_date), 0) - 1 as ret
      from bars)
group by 1, 2""")
def q_monthly_return(spark, sf_dir):
    return rounded(equity.monthly_returns(tb.bars(spark, sf_dir)))


@query("price_stats", _with(BARS) + """
select symbol, round(avg(close_price), 6) as avg_price, round(avg(volume), 6) as avg_volume,
       max(trade_date) as last_update
from bars group by 1""")
def q_price_stats(spark, sf_dir):
    return rounded(equity.price_stats(tb.bars(spark, sf_dir)))


# ----------------------------------------------------------------- macro ---

MONTHLY_SQL = """
select idx_type, cast(year(ref_date) as bigint) as ano, cast(month(ref_date) as bigint) as mes,
       strftime(ref_date, '%Y-%m') as ano_mes,
       avg(idx_value) as media_mensal, min(idx_value) as minimo_mensal, max(idx_value) as maximo_mensal,
       min(ref_date) as primeira_data_mes, max(ref_date) as ultima_data_mes,
       count(*) as num_medicoes
from series group by 1, 2, 3, 4"""

TREND_SQL = f"""
select idx_type,
       coalesce(case when isnan(s) then null else s end, 0) as trend_6m
from (select idx_type, regr_slope(idx_value, epoch(cast(ref_date as timestamp))) as s
      from series where ref_date >= date '{SERIES_AS_OF}' - interval 6 month
      group by 1)"""


def _monthly_ints(df: DataFrame) -> DataFrame:
    return df.withColumn("ano", F.col("ano").cast("bigint")).withColumn("mes", F.col("mes").cast("bigint"))


@query("macro_dashboard", _with(SERIES, ("monthly", MONTHLY_SQL), ("trend", TREND_SQL)) + """
select m.idx_type, ano, mes, ano_mes, round(media_mensal, 6) as media_mensal,
       round(minimo_mensal, 6) as minimo_mensal, round(maximo_mensal, 6) as maximo_mensal,
       round((media_mensal / nullif(lag(media_mensal) over (partition by m.idx_type order by ano, mes), 0) - 1) * 100, 6)
         as variacao_mes_anterior,
       primeira_data_mes, ultima_data_mes, num_medicoes,
       max(ultima_data_mes) over (partition by m.idx_type) as last_update,
       round(coalesce(t.trend_6m, 0), 12) as trend_6m
from monthly m left join trend t on m.idx_type = t.idx_type""")
def q_macro_dashboard(spark, sf_dir):
    out = macro.macro_dashboard(tb.series(spark, sf_dir), as_of=SERIES_AS_OF)
    return rounded(_monthly_ints(out), special={"trend_6m": 12})


@query("macro_dashboard_join", ORACLES["macro_dashboard"])
def q_macro_dashboard_join(spark, sf_dir):
    out = macro.macro_dashboard(tb.series(spark, sf_dir), as_of=SERIES_AS_OF, method="join")
    return rounded(_monthly_ints(out), special={"trend_6m": 12})


@query("monthly_rollup", _with(SERIES) + """
select idx_type, ano, mes, ano_mes, round(media_mensal, 6) as media_mensal,
       round(minimo_mensal, 6) as minimo_mensal, round(maximo_mensal, 6) as maximo_mensal,
       primeira_data_mes, ultima_data_mes, num_medicoes
from (""" + MONTHLY_SQL + ")")
def q_monthly_rollup(spark, sf_dir):
    return rounded(_monthly_ints(macro.monthly_rollup(tb.series(spark, sf_dir))))


@query("month_over_month", _with(SERIES, ("monthly", MONTHLY_SQL)) + """
select idx_type, ano, mes, round(media_mensal, 6) as media_mensal,
       round(prev, 6) as media_mes_anterior,
       round((media_mensal / nullif(prev, 0) - 1) * 100, 6) as variacao_mes_anterior
from (select *, lag(media_mensal) over (partition by idx_type order by ano, mes) as prev from monthly)""")
def q_month_over_month(spark, sf_dir):
    out = macro.month_over_month(macro.monthly_rollup(tb.series(spark, sf_dir)))
    return rounded(_monthly_ints(out.select("idx_type", "ano", "mes", "media_mensal",
                                            "media_mes_anterior", "variacao_mes_anterior")))


@query("last_update", _with(SERIES, ("monthly", MONTHLY_SQL)) + """
select idx_type, ano_mes, ultima_data_mes,
       max(ultima_data_mes) over (partition by idx_type) as last_update
from monthly""")
def q_last_update(spark, sf_dir):
    out = macro.with_last_update(macro.monthly_rollup(tb.series(spark, sf_dir)))
    return out.select("idx_type", "ano_mes", "ultima_data_mes", "last_update")


@query("trend_6m", _with(SERIES) + f"""
select idx_type, round(coalesce(case when isnan(s) then null else s end, 0), 12) as trend_6m
from (select idx_type, regr_slope(idx_value, epoch(cast(ref_date as timestamp))) as s
      from series where ref_date >= date '{SERIES_AS_OF}' - interval 6 month group by 1)""")
def q_trend_6m(spark, sf_dir):
    return rounded(macro.trend_6m(tb.series(spark, sf_dir), as_of=SERIES_AS_OF),
                   special={"trend_6m": 12})


def _change_sql(prefix: str, start: str) -> str:
    return _with(SERIES) + f"""
select idx_type, {prefix}_first, {prefix}_last,
       round(({prefix}_last / nullif({prefix}_first, 0) - 1) * 100, 6) as {prefix}_change
from (select idx_type, arg_min(idx_value, ref_date) as {prefix}_first,
             arg_max(idx_value, ref_date) as {prefix}_last
      from series where ref_date >= {start} group by 1)"""


@query("mtd_change", _change_sql("mtd", f"date_trunc('month', date '{SERIES_AS_OF}')"))
def q_mtd_change(spark, sf_dir):
    return rounded(macro.mtd_change(tb.series(spark, sf_dir), as_of=SERIES_AS_OF))


@query("ytd_change", _change_sql("ytd", f"date_trunc('year', date '{SERIES_AS_OF}')"))
def q_ytd_change(spark, sf_dir):
    return rounded(macro.ytd_change(tb.series(spark, sf_dir), as_of=SERIES_AS_OF))


@query("current_value", _with(SERIES) + f"""
select idx_type, arg_max(idx_value, ref_date) as current_value, max(ref_date) as value_date
from series where ref_date <= date '{SERIES_AS_OF}' group by 1""")
def q_current_value(spark, sf_dir):
    return rounded(macro.current_value(tb.series(spark, sf_dir), as_of=SERIES_AS_OF))


@query("macro_summary", _with(SERIES) + f"""
select idx_type,
       arg_max(idx_value, ref_date) filter (where ref_date <= date '{SERIES_AS_OF}') as current_value,
       round((arg_max(idx_value, ref_date) filter (where ref_date >= date_trunc('month', date '{SERIES_AS_OF}'))
              / nullif(arg_min(idx_value, ref_date) filter (where ref_date >= date_trunc('month', date '{SERIES_AS_OF}')), 0) - 1) * 100, 6)
         as mtd_change,
       round((arg_max(idx_value, ref_date) filter (where ref_date >= date_trunc('year', date '{SERIES_AS_OF}'))
              / nullif(arg_min(idx_value, ref_date) filter (where ref_date >= date_trunc('year', date '{SERIES_AS_OF}')), 0) - 1) * 100, 6)
         as ytd_change,
       round(coalesce(case when isnan(s) then null else s end, 0), 12) as trend_6m,
       max(ref_date) as last_update
from (select *, regr_slope(idx_value, epoch(cast(ref_date as timestamp)))
                  filter (where ref_date >= date '{SERIES_AS_OF}' - interval 6 month)
                  over (partition by idx_type) as s
      from series)
group by idx_type, s""")
def q_macro_summary(spark, sf_dir):
    return rounded(macro.macro_summary(tb.series(spark, sf_dir), as_of=SERIES_AS_OF),
                   special={"trend_6m": 12})


# Registered in sibling modules (imported last: they use the helpers above).
from tickforge.plans import (source_queries, check_queries, flow_queries, state_queries,  # noqa: E402,F401
                             layer_queries)
