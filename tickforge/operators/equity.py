"""Gold equity: daily return, monthly return, price statistics, performance.

Scale notes
-----------
* A window over a whole symbol puts that symbol's full history in one task.
  With few symbols (or one symbol holding a third of the rows) that is the
  bottleneck, so the default daily-return form splits each symbol into
  segments (calendar months): the lag runs inside ``(symbol, month)`` and the
  first row of a month takes the last close of the previous *present* month
  from a small month-level table (one row per symbol and month).
* ``equity_performance`` is one pass over silver: the month-level aggregate
  carries the partial sums for average price / volume and the latest date,
  so silver is scanned once and no join is needed. The exchange that feeds
  the ``(symbol, month)`` window is reused by the month aggregate, and the
  ``symbol`` exchange of the month-level lag is reused by the final
  aggregate (two exchanges in total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.numeric import safe_ratio, simple_return
from tickforge.session import written

# Segments (units of ``date_trunc``), coarsest first.
_SEGMENTS = ("month", "day", "hour")


def choose_segment(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                   max_rows: int = 1_000_000) -> str:
    """The coarsest segment (month, day, hour) whose densest (key, segment)
    group stays within ``max_rows`` rows, judged from the largest (key, day)
    count (one two-phase aggregate; the driver reads one number). ``hour`` is
    the finest segment offered, so it is the answer when a day is too dense."""
    per_day = df.groupBy(key, F.to_date(F.col(date)).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    day = per_day.agg(F.max("__n")).first()[0] or 0
    if day * 31 <= max_rows:
        return "month"
    if day <= max_rows:
        return "day"
    return "hour"


def _resolve(df: DataFrame, key: str, date: str, segment: str) -> str:
    return choose_segment(df, key, date) if segment == "auto" else segment


def _segment(date: str, segment: str):
    if segment not in _SEGMENTS:
        raise ValueError(f"segment must be one of {sorted(_SEGMENTS)}")
    return F.date_trunc(segment, F.col(date))


def daily_returns(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                  price: str = "close_price", method: str = "segmented",
                  segment: str = "month", out: str = "daily_return",
                  prev_out: str = "prev_close") -> DataFrame:
    """Add ``prev_out`` (previous close of the same key) and ``out`` = close/prev - 1.

    ``method="plain"`` is the textbook window over the whole key;
    ``method="segmented"`` (default) gives the same rows without ever
    holding a whole key in one task, as long as no segment is too dense for one;
    ``method="ranged"`` (:func:`_ranged_returns`) holds for any density.
    """
    if method == "ranged":
        return _ranged_returns(df, key, date, price, out, prev_out)
    if method == "plain":
        w = Window.partitionBy(key).orderBy(date, price)
        prev = F.lag(price).over(w)
        return df.withColumn(prev_out, prev).withColumn(out, simple_return(price, prev_out))
    if method != "segmented":
        raise ValueError("method must be 'segmented', 'ranged' or 'plain'")
    segment = _resolve(df, key, date, segment)

    seg = "__seg"
    # Rows of one date are ordered by price, so reruns agree. NULL dates are a
    # segment of their own that comes first, and NULL keys a key.
    w = Window.partitionBy(key, seg).orderBy(date, price)
    rows = (df.withColumn(seg, _segment(date, segment))
            .withColumn("__prev_in", F.lag(price).over(w))
            .withColumn("__first", F.row_number().over(w) == 1))
    # One row per (key, segment): its last close, then the previous present
    # segment's last close. Sized by keys x segments, not by rows. Built from
    # a narrow re-read (key, date, close) with a map-side partial aggregate,
    # so only keys x segments rows are shuffled for it; the wide rows are
    # shuffled once, for the window, and the join on (key, segment) reuses
    # that partitioning.
    seg_last = (df.withColumn(seg, _segment(date, segment))
                .groupBy(key, seg).agg(F.max(F.struct(date, price)).alias("__last"))
                .select(key, seg, F.col("__last")[price].alias("__seg_last")))
    seg_prev = seg_last.withColumn(
        "__seg_prev", F.lag("__seg_last").over(Window.partitionBy(key).orderBy(seg))
    ).select(F.col(key).alias("__pk"), F.col(seg).alias("__pseg"), "__seg_prev")
    out_df = (rows.join(seg_prev, F.col(key).eqNullSafe(F.col("__pk")) & F.col(seg).eqNullSafe(F.col("__pseg")), "left")
              .withColumn(prev_out, F.when(F.col("__first"), F.col("__seg_prev"))
                          .otherwise(F.col("__prev_in")))
              .withColumn(out, simple_return(price, prev_out)))
    return out_df.drop(seg, "__prev_in", "__first", "__seg_prev", "__pk", "__pseg")


def _ranged_returns(df: DataFrame, key: str, date: str, price: str, out: str, prev_out: str) -> DataFrame:
    """The lag over ranges of rows instead of keys or spans of time.

    The rows are dealt to ranges of (key, date, price) of about equal numbers of rows, so a key, a day or an
    instant of any density is spread over as many tasks as its rows need (rows equal in all three are dealt by
    their place in the input). The lag runs inside a range; the first row of a range takes the last row of the range
    before, from a table of one row a range. Rows are written once in between: what a range holds must not change
    between the two steps.
    """
    order = [F.col(key).asc_nulls_first(), F.col(date).asc_nulls_first(), F.col(price).asc_nulls_first(), F.col("__tie").asc()]
    dealt = (df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order)
             .withColumn("__range", F.spark_partition_id()))
    w = Window.partitionBy("__range").orderBy(*order)
    before = F.lag(F.struct(F.col(key).alias("k"), F.col(price).alias("p"))).over(w)
    rows = written(dealt.withColumn("__before", before), "ranged-returns")
    last = rows.groupBy("__range").agg(
        F.max_by(F.struct(F.col(key).alias("k"), F.col(price).alias("p")),
                 F.struct(F.col(key), F.col(date), F.col(price), F.col("__tie"))).alias("__end"))
    # One row a range: at most the number of shuffle partitions, whatever the table's size.
    ends = last.select((F.col("__range")).alias("__r"), F.lag("__end").over(Window.orderBy("__range")).alias("__end_before"))
    met = rows.join(F.broadcast(ends), F.col("__range") == F.col("__r"), "left")
    prev = F.when(F.col("__before").isNotNull(), F.col("__before")).otherwise(F.col("__end_before"))
    met = met.withColumn(prev_out, F.when(prev["k"].eqNullSafe(F.col(key)), prev["p"]))
    return met.withColumn(out, simple_return(price, prev_out)).drop("__tie", "__range", "__before", "__r", "__end_before")


def month_states(df: DataFrame, key: str = "symbol", date: str = "trade_date", price: str = "close_price",
                 volume: str | None = "volume", segment: str = "month") -> DataFrame:
    """What the metrics need of a month: one row per (key, ``ref_month``).

    Sum and number of the daily returns inside the month, its first and last close, the sums and counts of price and
    volume, the last date. No state needs another month's rows, so states can be stored, and only those of months that
    changed made again; :func:`performance_of_states` joins them.

    The lag runs inside (key, segment); ``segment="day"`` (or ``"hour"``) suits intraday rows: the segments of a
    month are then joined like the months, still without a window over a whole key. ``segment="ref_month"`` takes the
    months from a column of that name: on a table bucketed by (key, ref_month) no row is exchanged.
    """
    segment = _resolve(df, key, date, segment)
    if segment not in (*_SEGMENTS, "ref_month"):
        raise ValueError(f"segment must be 'ref_month' or one of {sorted(_SEGMENTS)}")
    span = "ref_month" if segment in ("month", "ref_month") else "__seg"
    rows = df if segment == "ref_month" else df.withColumn(span, _segment(date, segment))
    w = Window.partitionBy(key, span).orderBy(date, price)
    rows = rows.withColumn("__r", simple_return(price, F.lag(price).over(w)))
    first, last = F.min(F.struct(date, price))[price], F.max(F.struct(date, price))[price]
    aggs = [F.sum("__r").alias("sum_return"), F.count("__r").alias("n_return"),
            first.alias("first_close"), last.alias("last_close"),
            F.sum(price).alias("sum_price"), F.count(price).alias("n_price"), F.max(date).alias("last_date")]
    if volume:
        aggs += [F.sum(volume).alias("sum_volume"), F.count(volume).alias("n_volume")]
    states = rows.groupBy(key, span).agg(*aggs)
    if span == "ref_month":
        return states
    month = F.date_trunc("month", F.col(span))
    across = simple_return("first_close", F.lag("last_close").over(Window.partitionBy(key, month).orderBy(span)))
    states = states.withColumn("__across", across).withColumn("ref_month", month)
    added = F.coalesce(F.col("sum_return"), F.lit(0.0)) + F.coalesce(F.col("__across"), F.lit(0.0))
    n = F.sum(F.col("n_return") + F.when(F.col("__across").isNotNull(), 1).otherwise(0))
    sums = ["sum_price", "n_price"] + (["sum_volume", "n_volume"] if volume else [])
    order = F.struct(F.col(span))
    return states.groupBy(key, "ref_month").agg(
        F.when(n > 0, F.sum(added)).alias("sum_return"), n.alias("n_return"),
        F.min(F.struct(order.alias("s"), F.col("first_close").alias("c")))["c"].alias("first_close"),
        F.max(F.struct(order.alias("s"), F.col("last_close").alias("c")))["c"].alias("last_close"),
        F.max("last_date").alias("last_date"), *[F.sum(c).alias(c) for c in sums])


def _month_table(states: DataFrame, key: str) -> DataFrame:
    """Stored or fresh states with the month's mean daily return: the first return of a month is taken
    against the last close of the previous present month (a window over months, bounded by the calendar)."""
    first = simple_return("first_close", F.lag("last_close").over(Window.partitionBy(key).orderBy("ref_month")))
    states = states.withColumn("__first_r", first)
    total = F.coalesce(F.col("sum_return"), F.lit(0.0)) + F.coalesce(F.col("__first_r"), F.lit(0.0))
    n = F.col("n_return") + F.when(F.col("__first_r").isNotNull(), 1).otherwise(0)
    return states.withColumn("monthly_return", F.try_divide(total, n.cast("double"))).withColumn(
        "ano_mes", F.date_format("ref_month", "yyyy-MM"))


def performance_of_states(states: DataFrame, key: str = "symbol") -> DataFrame:
    """avg_return, volatility, avg_price, avg_volume and last_update per key, from :func:`month_states` alone."""
    return _month_table(states, key).groupBy(key).agg(
        F.avg("monthly_return").alias("avg_return"),
        F.stddev_samp("monthly_return").alias("volatility"),
        safe_ratio(F.sum("sum_price"), F.sum("n_price").cast("double")).alias("avg_price"),
        safe_ratio(F.sum("sum_volume"), F.sum("n_volume").cast("double")).alias("avg_volume"),
        F.max("last_date").alias("last_update"),
    )


def monthly_returns(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                    price: str = "close_price", segment: str = "month") -> DataFrame:
    """Mean daily return per key and month (``ano_mes`` = 'yyyy-MM')."""
    states = month_states(df, key, date, price, None, segment)
    return _month_table(states, key).select(key, "ano_mes", "monthly_return")


def price_stats(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                price: str = "close_price", volume: str = "volume") -> DataFrame:
    """Average close, average volume and latest date per key."""
    return df.groupBy(key).agg(
        F.avg(price).alias("avg_price"),
        F.avg(volume).alias("avg_volume"),
        F.max(date).alias("last_update"),
    )


def return_metrics(monthly: DataFrame, key: str = "symbol") -> DataFrame:
    """Mean and sample standard deviation of the monthly means per key."""
    return monthly.groupBy(key).agg(
        F.avg("monthly_return").alias("avg_return"),
        F.stddev_samp("monthly_return").alias("volatility"),
    )


def equity_performance(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                       price: str = "close_price", volume: str = "volume",
                       method: str = "one_pass", segment: str = "month") -> DataFrame:
    """Per key: avg_return, volatility, avg_price, avg_volume, last_update.

    ``one_pass`` (default) scans the input once; ``two_pass`` builds return
    metrics and price statistics separately and joins them on the key.
    ``segment`` bounds the window groups: ``month`` for daily bars, ``day``
    or ``hour`` for intraday rows, ``auto`` to choose from the data
    (:func:`choose_segment`, one extra aggregate).
    """
    if method == "two_pass":
        metrics = return_metrics(monthly_returns(df, key, date, price, segment), key)
        stats = price_stats(df, key, date, price, volume)
        return metrics.join(stats, key, "inner").select(
            key, "avg_return", "volatility", "avg_price", "avg_volume", "last_update")
    if method != "one_pass":
        raise ValueError("method must be 'one_pass' or 'two_pass'")
    return performance_of_states(month_states(df, key, date, price, volume, segment), key)
