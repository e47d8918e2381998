"""Gold macro: monthly indicator dashboard and its parts.

Scale notes
-----------
* Every step that touches daily rows is an aggregate (two-phase, map-side
  combine), so a hot indicator is pre-aggregated before any shuffle.
* Windows run only on month-level rows (one per indicator and month), whose
  count is bounded by the calendar, not by the data volume.
* ``macro_dashboard`` scans the series once: the six-month trend is folded
  into the monthly aggregate as per-month regression moments (count, means,
  co-moments from ``covar_pop`` / ``var_pop``) and pooled per indicator in
  the same window that computes the month-over-month change. The textbook
  form (separate trend aggregate + join) is ``method="join"``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.numeric import pct_change

SECONDS_PER_DAY = 86400.0


def as_of_col(as_of) -> Column:
    """``as_of`` as a DATE column: a date, ISO text (``yyyy-MM-dd``), the
    sources' ``dd/MM/yyyy`` text, or a Column; ``None`` means today
    (``current_date``)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.date())
    if isinstance(as_of, _dt.date):
        return F.lit(as_of)
    text = str(as_of)
    if "/" in text:
        return F.to_date(F.lit(text), "d/M/yyyy")
    return F.to_date(F.lit(text))


def until(df: DataFrame, as_of, date: str = "ref_date") -> DataFrame:
    """Rows known on ``as_of``: with an explicit day nothing after that day is
    read, so a past result repeats. "Now" (None) has no upper bound."""
    return df if as_of is None else df.filter(F.col(date) < F.date_add(as_of_col(as_of), 1))


def _epoch(date: str) -> Column:
    return F.unix_timestamp(F.col(date).cast("timestamp"))


def monthly_rollup(df: DataFrame, key: str = "idx_type", date: str = "ref_date",
                   value: str = "idx_value", extra_aggs=()) -> DataFrame:
    """Per key and calendar month: mean, min, max, first / last date, row count."""
    # Grouped by the month's first instant; year, month and text follow from it
    # after the aggregate, so no text is made or shuffled per row.
    month = F.date_trunc("month", F.col(date))
    monthly = df.groupBy(key, month.alias("__month")).agg(
        F.avg(value).alias("media_mensal"),
        F.min(value).alias("minimo_mensal"),
        F.max(value).alias("maximo_mensal"),
        F.min(date).alias("primeira_data_mes"),
        F.max(date).alias("ultima_data_mes"),
        F.count(F.lit(1)).alias("num_medicoes"),
        *extra_aggs,
    )
    rest = [c for c in monthly.columns if c not in (key, "__month")]
    return monthly.select(
        key, F.year("__month").alias("ano"), F.month("__month").alias("mes"),
        F.date_format("__month", "yyyy-MM").alias("ano_mes"), *rest)


def month_over_month(monthly: DataFrame, key: str = "idx_type") -> DataFrame:
    """Previous *present* month's mean (gaps skipped) and the % change."""
    w = Window.partitionBy(key).orderBy("ano", "mes")
    return (monthly
            .withColumn("media_mes_anterior", F.lag("media_mensal").over(w))
            .withColumn("variacao_mes_anterior",
                        pct_change("media_mensal", "media_mes_anterior")))


def with_last_update(monthly: DataFrame, key: str = "idx_type") -> DataFrame:
    """Latest date of the key, repeated on each of its month rows."""
    return monthly.withColumn(
        "last_update", F.max("ultima_data_mes").over(Window.partitionBy(key)))


def trend_6m(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
             value: str = "idx_value", months: int = 6, fill_zero: bool = True) -> DataFrame:
    """Least-squares slope of value on epoch seconds over the trailing months."""
    since = F.add_months(as_of_col(as_of), -months)
    slope = F.regr_slope(F.col(value), _epoch(date).cast("double"))
    out = until(df, as_of, date).filter(F.col(date) >= since).groupBy(key).agg(slope.alias("trend_6m"))
    if fill_zero:
        out = out.withColumn("trend_6m", F.coalesce(F.col("trend_6m"), F.lit(0.0)))
    return out


def _window_change(df: DataFrame, since: Column, key: str, date: str, value: str,
                   prefix: str) -> DataFrame:
    """First / last value from ``since`` on and the % change between them."""
    return (df.filter(F.col(date) >= since)
            .groupBy(key)
            .agg(F.min_by(value, date).alias(f"{prefix}_first"),
                 F.max_by(value, date).alias(f"{prefix}_last"))
            .withColumn(f"{prefix}_change", pct_change(f"{prefix}_last", f"{prefix}_first")))


def mtd_change(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
               value: str = "idx_value") -> DataFrame:
    """Month-to-date change: earliest vs latest value since the month start."""
    return _window_change(until(df, as_of, date), F.trunc(as_of_col(as_of), "MM"), key, date, value, "mtd")


def ytd_change(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
               value: str = "idx_value") -> DataFrame:
    """Year-to-date change: earliest vs latest value since January 1st."""
    return _window_change(until(df, as_of, date), F.trunc(as_of_col(as_of), "YEAR"), key, date, value, "ytd")


def current_value(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
                  value: str = "idx_value") -> DataFrame:
    """Latest value on or before ``as_of`` and its date."""
    upto = F.date_add(as_of_col(as_of), 1)
    return (df.filter(F.col(date) < upto)
            .groupBy(key)
            .agg(F.max_by(value, date).alias("current_value"),
                 F.max(date).alias("value_date")))


def macro_summary(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
                  value: str = "idx_value", months: int = 6) -> DataFrame:
    """One row per key with the registry's dashboard columns: current_value,
    mtd_change, ytd_change, trend_6m, last_update — one aggregate, one scan."""
    df = until(df, as_of, date)
    a = as_of_col(as_of)
    d = F.col(date)

    def since(start):
        return F.when(d >= start, d)

    upto = F.when(d < F.date_add(a, 1), d)
    in6 = d >= F.add_months(a, -months)
    mtd_first = F.min_by(value, since(F.trunc(a, "MM")))
    mtd_last = F.max_by(value, since(F.trunc(a, "MM")))
    ytd_first = F.min_by(value, since(F.trunc(a, "YEAR")))
    ytd_last = F.max_by(value, since(F.trunc(a, "YEAR")))
    slope = F.regr_slope(F.when(in6, F.col(value)), F.when(in6, _epoch(date).cast("double")))
    return df.groupBy(key).agg(
        F.max_by(value, upto).alias("current_value"),
        pct_change(mtd_last, mtd_first).alias("mtd_change"),
        pct_change(ytd_last, ytd_first).alias("ytd_change"),
        F.coalesce(slope, F.lit(0.0)).alias("trend_6m"),
        F.max(date).alias("last_update"),
    )


DASHBOARD_COLUMNS = [
    "idx_type", "ano", "mes", "ano_mes", "media_mensal", "minimo_mensal",
    "maximo_mensal", "variacao_mes_anterior", "primeira_data_mes",
    "ultima_data_mes", "num_medicoes", "last_update", "trend_6m",
]


def macro_dashboard(df: DataFrame, as_of=None, key: str = "idx_type", date: str = "ref_date",
                    value: str = "idx_value", months: int = 6, method: str = "one_pass",
                    sort: bool = True) -> DataFrame:
    """Monthly dashboard per indicator (13 columns, see ``DASHBOARD_COLUMNS``).

    With an explicit ``as_of`` the dashboard is the one of that day: later rows
    count in none of its columns.
    """
    df = until(df, as_of, date)
    if method == "join":
        monthly = with_last_update(month_over_month(monthly_rollup(df, key, date, value), key), key)
        trend = trend_6m(df, as_of, key, date, value, months, fill_zero=False)
        out = monthly.join(trend, key, "left").withColumn(
            "trend_6m", F.coalesce(F.col("trend_6m"), F.lit(0.0)))
    elif method == "one_pass":
        a = as_of_col(as_of)
        since = F.add_months(a, -months)
        in6 = (F.col(date) >= since) & F.col(value).isNotNull()
        # x in days, centred on the middle of the window (a constant shift
        # leaves the slope unchanged): the pooled means of x are then near 0,
        # so pooling the per-month co-moments below cancels almost nothing.
        centre = _centre(a, since)
        x = (_epoch(date) - centre).cast("double") / SECONDS_PER_DAY
        # Computed once per row, then shared by the moment aggregates.
        df = df.withColumns({"__x": F.when(in6, x), "__y": F.when(in6, F.col(value))})
        monthly = month_over_month(monthly_rollup(df, key, date, value, _moments()), key)
        # Pool the per-month moments per key in the same window pass.
        wk = Window.partitionBy(key)
        pooled = monthly.select("*", F.max("ultima_data_mes").over(wk).alias("last_update"),
                                *[f.over(wk).alias(n) for n, f in _pooled().items()])
        out = pooled.withColumn("trend_6m", F.coalesce(_slope() / F.lit(SECONDS_PER_DAY), F.lit(0.0)))
    else:
        raise ValueError("method must be 'one_pass' or 'join'")
    out = out.select(*DASHBOARD_COLUMNS)
    return out.orderBy(key, "ano", "mes") if sort else out


def _centre(a: Column, since: Column) -> Column:
    """Epoch second in the middle of the trend's window."""
    return F.unix_timestamp(a.cast("timestamp")) - F.datediff(a, since) * (SECONDS_PER_DAY / 2)


def _moments() -> list[Column]:
    """Regression moments of ``__y`` on ``__x`` (both NULL where a row does not count)."""
    x, y = F.col("__x"), F.col("__y")
    return [F.count(y).alias("__n"), F.avg(x).alias("__mx"), F.avg(y).alias("__my"),
            (F.covar_pop(y, x) * F.count(y)).alias("__cxy"), (F.var_pop(x) * F.count(y)).alias("__sxx"),
            F.min(x).alias("__x_lo"), F.max(x).alias("__x_hi")]


def _pooled() -> dict[str, Column]:
    """Sums that pool moments: Cxy = sum(C_m + n_m*mx_m*my_m) - SX*SY/N, Sxx likewise."""
    n = F.col("__n").cast("double")
    mx, my = F.coalesce(F.col("__mx"), F.lit(0.0)), F.coalesce(F.col("__my"), F.lit(0.0))
    return {"__pool_n": F.sum(n), "__pool_sx": F.sum(n * mx), "__pool_sy": F.sum(n * my),
            "__pool_sxy": F.sum(F.coalesce(F.col("__cxy"), F.lit(0.0)) + n * mx * my),
            "__pool_sxx": F.sum(F.coalesce(F.col("__sxx"), F.lit(0.0)) + n * mx * mx),
            "__pool_x_lo": F.min("__x_lo"), "__pool_x_hi": F.max("__x_hi")}


def _slope() -> Column:
    """Slope per day of pooled moments."""
    n = F.col("__pool_n")
    cxy = F.col("__pool_sxy") - F.try_divide(F.col("__pool_sx") * F.col("__pool_sy"), n)
    sxx = F.col("__pool_sxx") - F.try_divide(F.col("__pool_sx") * F.col("__pool_sx"), n)
    # A zero spread of x (one day only) means no slope, like regr_slope.
    return F.when(F.col("__pool_x_lo") < F.col("__pool_x_hi"), F.try_divide(cxy, sxx))


# Columns of a stored month state: the roll-up, and moments with x in days since the month's first instant.
_STATE_MOMENTS = {"__n": "n_values", "__mx": "mean_day", "__my": "mean_value", "__cxy": "co_moment", "__sxx": "day_moment",
                  "__x_lo": "first_day", "__x_hi": "last_day"}


def month_states(df: DataFrame, key: str = "idx_type", date: str = "ref_date", value: str = "idx_value") -> DataFrame:
    """One row per (key, ``ref_month``) with all that the dashboard needs of a month; no state needs another month's rows."""
    start = F.date_trunc("month", F.col(date))
    x = (_epoch(date) - F.unix_timestamp(start.cast("timestamp"))).cast("double") / SECONDS_PER_DAY
    counts = F.col(value).isNotNull()
    rows = df.withColumns({"__x": F.when(counts, x), "__y": F.when(counts, F.col(value))})
    monthly = monthly_rollup(rows, key, date, value, [*_moments(), F.min(start).alias("ref_month")])
    return monthly.withColumnsRenamed(_STATE_MOMENTS)


def edge_months(as_of: _dt.date, months: int = 6) -> list[str]:
    """The months of which the dashboard of a day needs single rows: that of the day, and the one in which the trend begins."""
    y, m = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    return sorted({f"{y:04d}-{m + 1:02d}", f"{as_of.year:04d}-{as_of.month:02d}"})


def dashboard_of_states(states: DataFrame, edges: DataFrame, as_of: _dt.date, key: str = "idx_type", date: str = "ref_date",
                        value: str = "idx_value", months: int = 6, sort: bool = True) -> DataFrame:
    """The dashboard of a day from stored states (:func:`month_states`) and the single rows of the :func:`edge_months` alone.

    The states give all whole months; the month of ``as_of`` is rolled up from its rows up to that day, and
    of the month in which the trend begins the rows from that day on count.
    """
    a = as_of_col(as_of)
    since = F.add_months(a, -months)
    start = F.col("ref_month").cast("date")
    edges = until(edges, as_of, date)
    this_month = month_states(edges.filter(F.col(date) >= F.trunc(a, "MM")), key, date, value)
    whole = states.filter(start < F.trunc(a, "MM")).unionByName(this_month)
    monthly = with_last_update(month_over_month(whole, key), key)
    # Whole months inside the window, and what of its first month counts.
    begun = month_states(edges.filter((F.col(date) >= since) & (F.col(date) < F.add_months(F.trunc(since, "MM"), 1))), key, date, value)
    inside = whole.filter(start > F.trunc(since, "MM")).unionByName(begun)
    shift = (F.unix_timestamp(F.col("ref_month").cast("timestamp")) - _centre(a, since)) / SECONDS_PER_DAY
    inside = inside.withColumnsRenamed({v: k for k, v in _STATE_MOMENTS.items()}).withColumns(
        {c: F.col(c) + shift for c in ("__mx", "__x_lo", "__x_hi")})
    trend = inside.groupBy(key).agg(*[f.alias(n) for n, f in _pooled().items()]).select(
        F.col(key).alias("__tk"), (_slope() / F.lit(SECONDS_PER_DAY)).alias("trend_6m"))
    out = monthly.join(trend, F.col(key).eqNullSafe(F.col("__tk")), "left").withColumn(
        "trend_6m", F.coalesce(F.col("trend_6m"), F.lit(0.0)))
    out = out.select(*DASHBOARD_COLUMNS)
    return out.orderBy(key, "ano", "mes") if sort else out
