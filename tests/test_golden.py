"""Hand-worked golden rows (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickforge.operators import equity, macro

D = dt.date


@pytest.fixture(scope="module")
def bars(spark):
    rows = [("a", D(2024, 1, 2), 10.0), ("a", D(2024, 1, 3), 11.0), ("a", D(2024, 2, 1), 12.1),
            ("a", D(2024, 2, 2), 0.0), ("a", D(2024, 2, 5), 5.0), ("b", D(2024, 1, 2), 5.0)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close_price double") \
        .withColumn("volume", F.lit(100.0))


@pytest.mark.parametrize("method", ["segmented", "plain"])
def test_daily_returns(bars, method):
    out = {(r.symbol, r.trade_date): r.daily_return
           for r in equity.daily_returns(bars, method=method).collect()}
    assert out[("a", D(2024, 1, 2))] is None
    assert out[("a", D(2024, 1, 3))] == pytest.approx(0.1)
    assert out[("a", D(2024, 2, 1))] == pytest.approx(0.1)
    assert out[("a", D(2024, 2, 2))] == pytest.approx(-1.0)
    assert out[("a", D(2024, 2, 5))] is None  # 5 / 0
    assert out[("b", D(2024, 1, 2))] is None


def test_monthly_returns(bars):
    out = {(r.symbol, r.ano_mes): r.monthly_return for r in equity.monthly_returns(bars).collect()}
    assert out[("a", "2024-01")] == pytest.approx(0.1)
    assert out[("a", "2024-02")] == pytest.approx(-0.45)
    assert out[("b", "2024-01")] is None


@pytest.mark.parametrize("method", ["one_pass", "two_pass"])
def test_equity_performance(bars, method):
    out = {r.symbol: r for r in equity.equity_performance(bars, method=method).collect()}
    a, b = out["a"], out["b"]
    assert a.avg_return == pytest.approx(-0.175)
    assert a.volatility == pytest.approx(0.388909, abs=1e-6)
    assert a.avg_price == pytest.approx(7.62)
    assert a.last_update == D(2024, 2, 5)
    assert b.avg_return is None and b.volatility is None
    assert b.avg_price == pytest.approx(5.0)
    assert b.last_update == D(2024, 1, 2)


@pytest.fixture(scope="module")
def selic(spark):
    rows = [("selic", dt.datetime(2024, 1, 1), 10.0), ("selic", dt.datetime(2024, 1, 31), 12.0),
            ("selic", dt.datetime(2024, 3, 1), 22.0), ("one", dt.datetime(2024, 3, 2), 7.0)]
    return spark.createDataFrame(rows, "idx_type string, ref_date timestamp, idx_value double")


@pytest.mark.parametrize("method", ["one_pass", "join"])
def test_macro_dashboard(selic, method):
    rows = macro.macro_dashboard(selic, as_of="2024-03-15", method=method).collect()
    s = [r for r in rows if r.idx_type == "selic"]
    assert [r.ano_mes for r in s] == ["2024-01", "2024-03"]
    jan, mar = s
    assert (jan.media_mensal, jan.minimo_mensal, jan.maximo_mensal) == (11.0, 10.0, 12.0)
    assert jan.variacao_mes_anterior is None
    assert jan.primeira_data_mes == dt.datetime(2024, 1, 1)
    assert jan.ultima_data_mes == dt.datetime(2024, 1, 31)
    assert jan.num_medicoes == 2
    assert mar.variacao_mes_anterior == pytest.approx(100.0)  # gap month skipped
    assert mar.num_medicoes == 1
    assert jan.last_update == mar.last_update == dt.datetime(2024, 3, 1)
    assert jan.trend_6m == pytest.approx(0.2 / 86400, rel=1e-9)
    assert mar.trend_6m == pytest.approx(2.314815e-06, rel=1e-6)
    one = [r for r in rows if r.idx_type == "one"]
    assert one[0].trend_6m == 0.0  # one point: no slope -> 0


def test_mtd_and_summary(selic):
    m = {r.idx_type: r for r in macro.mtd_change(selic, as_of="2024-03-15").collect()}
    assert m["selic"].mtd_change == 0.0
    s = {r.idx_type: r for r in macro.macro_summary(selic, as_of="2024-03-15").collect()}
    assert s["selic"].current_value == 22.0
    assert s["selic"].mtd_change == 0.0
    assert s["selic"].ytd_change == pytest.approx(120.0)
    assert s["selic"].trend_6m == pytest.approx(0.2 / 86400, rel=1e-9)
    assert s["one"].trend_6m == 0.0


def test_trend_window_filter(selic):
    # Only points on or after as_of - 6 months count.
    t = {r.idx_type: r.trend_6m for r in macro.trend_6m(selic, as_of="2024-08-31").collect()}
    assert "selic" in t and t["selic"] == 0.0  # only 2024-03-01 is within (since 2024-02-29)


@pytest.mark.parametrize("method", ["one_pass", "two_pass"])
def test_day_segments_equal_month_segments(bars, method, spark):
    a = equity.equity_performance(bars, method=method, segment="month")
    b = equity.equity_performance(bars, method=method, segment="day")
    ra = {r.symbol: r for r in a.collect()}
    for r in b.collect():
        for f in ("avg_return", "volatility", "avg_price", "avg_volume"):
            x, y = getattr(ra[r.symbol], f), getattr(r, f)
            assert (x is None and y is None) or x == pytest.approx(y)


def test_choose_segment(spark):
    from tests.conftest import SF001
    from tickforge.sources import tables as tb
    ev = tb.event_bars(spark, SF001)
    assert equity.choose_segment(ev) == "month"
    assert equity.choose_segment(ev, max_rows=200) == "day"
    assert equity.choose_segment(ev, max_rows=3) == "hour"
    a = {r.symbol: r.avg_return for r in equity.equity_performance(ev, segment="auto").collect()}
    b = {r.symbol: r.avg_return for r in equity.equity_performance(ev, segment="hour").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_as_of_formats(selic):
    a = macro.mtd_change(selic, as_of="15/03/2024").collect()
    b = macro.mtd_change(selic, as_of="2024-03-15").collect()
    c = macro.mtd_change(selic, as_of=dt.date(2024, 3, 15)).collect()
    assert a == b == c
