"""Property tests: the scale-oriented forms equal the textbook forms on
random inputs (gaps, ties in value, NULL and zero prices, several keys)."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickforge.operators import equity, macro

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

price = st.one_of(st.none(), st.just(0.0), st.floats(0.5, 500, allow_nan=False))
bar_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 400), price),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))


def _bars(spark, rows):
    base = dt.date(2023, 11, 20)
    data = [(k, base + dt.timedelta(days=d), p, 1.0) for k, d, p in rows]
    return spark.createDataFrame(data, "symbol string, trade_date date, close_price double, volume double")


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-12)
    return a == b


@SETTINGS
@given(rows=bar_rows)
def test_segmented_return_equals_plain(spark, rows):
    df = _bars(spark, rows)
    seg = {(r.symbol, r.trade_date): r.daily_return for r in equity.daily_returns(df).collect()}
    plain = {(r.symbol, r.trade_date): r.daily_return
             for r in equity.daily_returns(df, method="plain").collect()}
    assert seg.keys() == plain.keys()
    assert all(_same(seg[k], plain[k]) for k in seg)


@SETTINGS
@given(rows=bar_rows, segment=st.sampled_from(["month", "day"]))
def test_one_pass_equals_two_pass(spark, rows, segment):
    df = _bars(spark, rows)
    a = {r.symbol: r for r in equity.equity_performance(df, segment=segment).collect()}
    b = {r.symbol: r for r in equity.equity_performance(df, method="two_pass").collect()}
    assert a.keys() == b.keys()
    for k in a:
        for f in ("avg_return", "volatility", "avg_price", "avg_volume", "last_update"):
            assert _same(getattr(a[k], f), getattr(b[k], f)), (k, f)


series_rows = st.lists(
    st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 330), st.floats(-1e3, 1e3, allow_nan=False)),
    min_size=1, max_size=50, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(rows=series_rows)
def test_pooled_trend_equals_regr_slope(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(k, base + dt.timedelta(days=d), v) for k, d, v in rows]
    df = spark.createDataFrame(data, "idx_type string, ref_date date, idx_value double")
    as_of = "2024-11-26"
    one = {r.idx_type: r.trend_6m for r in
           macro.macro_dashboard(df, as_of=as_of).select("idx_type", "trend_6m").distinct().collect()}
    ref = {r.idx_type: r.trend_6m for r in macro.trend_6m(df, as_of=as_of).collect()}
    for k, v in one.items():
        assert v == pytest.approx(ref.get(k, 0.0), rel=1e-7, abs=1e-15)
    # Cross-check against numpy least squares on the same window.
    for k in one:
        pts = [(d, v) for kk, d, v in rows if kk == k and base + dt.timedelta(days=d) >= dt.date(2024, 5, 26)]
        if len({d for d, _ in pts}) >= 2:
            x = np.array([d * 86400.0 for d, _ in pts]); y = np.array([v for _, v in pts])
            slope = np.polyfit(x, y, 1)[0]
            assert one[k] == pytest.approx(slope, rel=1e-6, abs=1e-15)
        else:
            assert one[k] == 0.0


@SETTINGS
@given(rows=series_rows, as_of_day=st.integers(200, 330))
def test_summary_equals_separate_operators(spark, rows, as_of_day):
    base = dt.date(2024, 1, 1)
    data = [(k, base + dt.timedelta(days=d), v) for k, d, v in rows]
    df = spark.createDataFrame(data, "idx_type string, ref_date date, idx_value double")
    as_of = (base + dt.timedelta(days=as_of_day)).isoformat()
    s = {r.idx_type: r for r in macro.macro_summary(df, as_of=as_of).collect()}
    cur = {r.idx_type: r.current_value for r in macro.current_value(df, as_of=as_of).collect()}
    mtd = {r.idx_type: r.mtd_change for r in macro.mtd_change(df, as_of=as_of).collect()}
    ytd = {r.idx_type: r.ytd_change for r in macro.ytd_change(df, as_of=as_of).collect()}
    tr = {r.idx_type: r.trend_6m for r in macro.trend_6m(df, as_of=as_of).collect()}
    for k, r in s.items():
        assert _same(r.current_value, cur.get(k))
        assert _same(r.mtd_change, mtd.get(k))
        assert _same(r.ytd_change, ytd.get(k))
        assert r.trend_6m == pytest.approx(tr.get(k, 0.0), rel=1e-7, abs=1e-15)


@SETTINGS
@given(values=st.lists(st.tuples(st.sampled_from(["g1", "g2"]),
                                  st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6, allow_nan=False))),
                       min_size=1, max_size=80),
       probs=st.lists(st.floats(0, 1), min_size=1, max_size=4, unique=True),
       final_rows=st.sampled_from([1, 3, 1000]))
def test_exact_quantiles_property(spark, values, probs, final_rows):
    from tickforge.operators.quantiles import exact_quantiles
    df = spark.createDataFrame(values, "k string, v double")
    got = {(r.k, r.p): r.quantile for r in
           exact_quantiles(df, "v", probs, ["k"], final_rows=final_rows).collect()}
    for key in {k for k, _ in values}:
        arr = np.array([v for k, v in values if k == key])
        for p in probs:
            assert got[(key, p)] == pytest.approx(np.quantile(arr, p), rel=1e-9, abs=1e-9)


intraday_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60 * 24 * 45), price),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(rows=intraday_rows, segment=st.sampled_from(["day", "hour"]))
def test_intraday_segments_equal_plain(spark, rows, segment):
    base = dt.datetime(2024, 1, 30, 22, 0)
    data = [(k, base + dt.timedelta(minutes=m), p, 1.0) for k, m, p in rows]
    df = spark.createDataFrame(data, "symbol string, trade_date timestamp_ntz, close_price double, volume double")
    seg = {(r.symbol, r.trade_date): r.daily_return for r in equity.daily_returns(df, segment=segment).collect()}
    plain = {(r.symbol, r.trade_date): r.daily_return
             for r in equity.daily_returns(df, method="plain").collect()}
    assert seg.keys() == plain.keys() and all(_same(seg[k], plain[k]) for k in seg)
    a = {r.symbol: r for r in equity.equity_performance(df, segment=segment).collect()}
    b = {r.symbol: r for r in equity.equity_performance(df, method="two_pass", segment="month").collect()}
    for k in a:
        for f in ("avg_return", "volatility", "avg_price"):
            assert _same(getattr(a[k], f), getattr(b[k], f)), (k, f)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 200)),
                          st.integers(1, 9)), min_size=1, max_size=40))
def test_segmented_equals_plain_with_nulls(spark, rows):
    """NULL symbols and NULL dates keep their previous close; ties are settled by price."""
    import datetime as dt
    data = [(k, None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d), float(p)) for k, d, p in rows]
    df = spark.createDataFrame(data, "symbol string, trade_date timestamp, close_price double")
    a = equity.daily_returns(df, method="plain").select("symbol", "trade_date", "close_price", "prev_close")
    b = equity.daily_returns(df).select("symbol", "trade_date", "close_price", "prev_close")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
