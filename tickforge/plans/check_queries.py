"""Registered queries: row checks, source status and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.functions.numeric import tolerant_double
from tickforge.operators import profile, quality
from tickforge.plans.registry import BARS, SERIES, _with, query, rounded
from tickforge.plans.fixtures import BROKEN_SQL, broken_bars, tolerant_sql as _tolerant_sql
from tickforge.sources import config as cfg
from tickforge.sources import tables as tb

# Fixed parameters: requested tickers (with blanks, a suffix, a lower-case
# and an unknown key) and the status period.
REQUESTED = "1-URGENT, 2-high.SA ,9-MISSING,,5-LOW"
STATUS_START, STATUS_END = "01/08/2001", "01/08/2001"


def broken_silver(spark, sf_dir):
    """Silver-shaped rows with unparseable closes as NULL and some dates missing."""
    raw = broken_bars(tb.bars(spark, sf_dir))
    return raw.select(F.col("Date").alias("trade_date"), F.col("ticker").alias("symbol"),
                      F.col("Open").alias("open_price"),
                      tolerant_double("Close").alias("close_price"),
                      tolerant_double("Volume").alias("volume"))


BROKEN_SILVER_SQL = ("s", f"""
    select Date as trade_date, ticker as symbol, Open as open_price,
           {_tolerant_sql('Close')} as close_price, {_tolerant_sql('Volume')} as volume
    from raw""")

CHECKS = quality.SILVER_EQUITY_CHECKS + [
    quality.Check("symbol_not_null", "symbol IS NOT NULL")]


@query("quality_report", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL) + """
select 'valid_close' as check_name, count(*) filter (where close_price is not null) as passed,
       count(*) filter (where close_price is null) as failed from s
union all
select 'valid_date', count(*) filter (where trade_date is not null),
       count(*) filter (where trade_date is null) from s
union all
select 'symbol_not_null', count(*) filter (where symbol is not null),
       count(*) filter (where symbol is null) from s""")
def q_quality_report(spark, sf_dir):
    rep = quality.check_report(broken_silver(spark, sf_dir), CHECKS)
    return rep.withColumnRenamed("check", "check_name")


@query("quality_drop", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL) + """
select * from s where close_price is not null and trade_date is not null and symbol is not null""")
def q_quality_drop(spark, sf_dir):
    return rounded(quality.apply_checks(broken_silver(spark, sf_dir), CHECKS, mode="drop"))


@query("source_status", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL, ("req", f"""
    select cast(pos as bigint) as position, upper(replace(item, '.SA', '')) as symbol
    from (select unnest(l) as item, unnest(range(0, len(l))) as pos
          from (select list_filter(list_transform(string_split('{REQUESTED}', ','), lambda x: trim(x)),
                                   lambda x: x <> '') as l))"""), ("cnt", """
    select symbol, count(*) as rows_total,
           count(*) filter (where trade_date >= timestamp '2001-08-01' and trade_date <= timestamp '2001-08-01') as rows_in_period,
           count(*) filter (where trade_date >= timestamp '2001-08-01' and trade_date <= timestamp '2001-08-01'
                            and close_price is not null) as rows_valid
    from s group by symbol""")) + """
select r.position, r.symbol,
       case when coalesce(c.rows_total, 0) = 0 then 'no_data'
            when coalesce(c.rows_in_period, 0) = 0 then 'none_in_period'
            when coalesce(c.rows_valid, 0) = 0 then 'all_invalid' else 'ok' end as status,
       coalesce(c.rows_total, 0) as rows_total, coalesce(c.rows_in_period, 0) as rows_in_period,
       coalesce(c.rows_valid, 0) as rows_valid
from req r left join cnt c on r.symbol = c.symbol""")
def q_source_status(spark, sf_dir):
    req = cfg.ticker_list(spark, REQUESTED).withColumn("position", F.col("position").cast("bigint"))
    out = quality.source_status(req, broken_silver(spark, sf_dir), STATUS_START, STATUS_END)
    return out.select("position", "symbol", "status", "rows_total", "rows_in_period", "rows_valid")


@query("coverage", _with(SERIES) + """
select count(*) as rows, count(distinct idx_type) as n_keys, min(ref_date) as first_date,
       max(ref_date) as last_date from series""")
def q_coverage(spark, sf_dir):
    return profile.coverage(tb.series(spark, sf_dir), "idx_type", "ref_date")


@query("rows_per_key", _with(BARS) + "select symbol, count(*) as n_rows from bars group by 1")
def q_rows_per_key(spark, sf_dir):
    return profile.rows_per_key(tb.bars(spark, sf_dir), "symbol")


def _describe_sql(source: str, cols: list[str], by: str | None) -> str:
    keys = f"{by}, column_name" if by else "column_name"
    return f"""
select {keys}, count(value) as count, round(avg(value), 6) as mean,
       round(stddev_samp(value), 6) as std, round(min(value), 6) as min,
       round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
       round(quantile_cont(value, 0.75), 6) as q75, round(max(value), 6) as max
from (unpivot (select {by + ', ' if by else ''}{', '.join(cols)} from {source})
      on {', '.join(cols)} into name column_name value value)
group by {keys}"""


BAR_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "volume"]


@query("describe", _with(BARS) + _describe_sql("bars", BAR_COLUMNS, None))
def q_describe(spark, sf_dir):
    return rounded(profile.describe(tb.bars(spark, sf_dir), BAR_COLUMNS))


@query("describe_by_key", _with(SERIES) + _describe_sql("series", ["idx_value"], "idx_type"))
def q_describe_by_key(spark, sf_dir):
    return rounded(profile.describe(tb.series(spark, sf_dir), ["idx_value"], by="idx_type"))


@query("null_counts", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL) + """
select 'trade_date' as column_name, count(*) filter (where trade_date is null) as nulls from s
union all select 'symbol', count(*) filter (where symbol is null) from s
union all select 'open_price', count(*) filter (where open_price is null or isnan(open_price)) from s
union all select 'close_price', count(*) filter (where close_price is null or isnan(close_price)) from s
union all select 'volume', count(*) filter (where volume is null or isnan(volume)) from s""")
def q_null_counts(spark, sf_dir):
    return profile.null_counts(broken_silver(spark, sf_dir))


@query("distinct_keys", _with(SERIES) + "select distinct idx_type from series")
def q_distinct_keys(spark, sf_dir):
    return profile.distinct_keys(tb.series(spark, sf_dir), "idx_type")


@query("column_info", _with(BARS) + """
select t.position, t.column_name, t.type, c.non_null
from (values (0, 'symbol', 'string'), (1, 'trade_date', 'timestamp_ntz'), (2, 'open_price', 'double'),
             (3, 'high_price', 'double'), (4, 'low_price', 'double'), (5, 'close_price', 'double'),
             (6, 'volume', 'double')) t(position, column_name, type)
join (select unnest(['symbol', 'trade_date', 'open_price', 'high_price', 'low_price', 'close_price', 'volume']) as column_name,
             unnest([count(symbol), count(trade_date), count(open_price), count(high_price),
                     count(low_price), count(close_price), count(volume)]) as non_null
      from bars) c on t.column_name = c.column_name""")
def q_column_info(spark, sf_dir):
    out = profile.column_info(tb.bars(spark, sf_dir))
    return out.withColumn("position", F.col("position").cast("int"))


@query("head_per_key", _with(SERIES) + """
select idx_type, ref_date, idx_value, rn
from (select *, row_number() over (partition by idx_type order by ref_date) as rn from series)
where rn <= 5""")
def q_head_per_key(spark, sf_dir):
    out = profile.head_per_key(tb.series(spark, sf_dir), "idx_type", "ref_date", 5)
    return rounded(out.withColumn("rn", F.col("rn").cast("bigint")))


@query("head", _with(BARS) + """
select * from bars order by trade_date, symbol limit 5""")
def q_head(spark, sf_dir):
    return rounded(profile.head(tb.bars(spark, sf_dir), ["trade_date", "symbol"], 5))


@query("profile_table", _with(BARS, BROKEN_SQL, BROKEN_SILVER_SQL, ("t", """
    select count(*) as rows, count(distinct symbol) as n_keys, min(trade_date) as first_date,
           max(trade_date) as last_date,
           count(trade_date) as nn0, count(*) - count(trade_date) as nu0,
           count(symbol) as nn1, count(*) - count(symbol) as nu1,
           count(*) filter (where open_price is not null and not isnan(open_price)) as nn2,
           count(*) filter (where open_price is null or isnan(open_price)) as nu2,
           count(*) filter (where close_price is not null and not isnan(close_price)) as nn3,
           count(*) filter (where close_price is null or isnan(close_price)) as nu3,
           count(*) filter (where volume is not null and not isnan(volume)) as nn4,
           count(*) filter (where volume is null or isnan(volume)) as nu4
    from s""")) + """
select c.position, c.column_name, c.type,
       case c.position when 0 then nn0 when 1 then nn1 when 2 then nn2 when 3 then nn3 else nn4 end as non_null,
       case c.position when 0 then nu0 when 1 then nu1 when 2 then nu2 when 3 then nu3 else nu4 end as nulls,
       rows, n_keys, first_date, last_date
from t, (values (0, 'trade_date', 'timestamp'), (1, 'symbol', 'string'), (2, 'open_price', 'double'),
                (3, 'close_price', 'double'), (4, 'volume', 'double')) c(position, column_name, type)""")
def q_profile_table(spark, sf_dir):
    out = profile.profile_table(broken_silver(spark, sf_dir), "symbol", "trade_date")
    return rounded(out.withColumn("position", F.col("position").cast("int")))
