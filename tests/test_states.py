"""Commit log, month tables, states, ranges, coverage: what survives a crash and what is read again."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.test_flow import _document, _land
from tickforge.operators import coverage, equity, macro, profile, quality
from tickforge.plans import medallion
from tickforge.plans.gold_states import QuoteLayer, SeriesLayer
from tickforge.plans.inspect import plan_summary
from tickforge.plans.source_queries import forget_last_commit
from tickforge.sources import payload as pl
from tickforge.sources import quote_source
from tickforge.sources import tables as tb
from tickforge.streaming import incremental
from tickforge.streaming.commits import CommitConflict, CommitLog, Entry
from tickforge.streaming.month_table import MonthTable

DAY = 86400


def _run(spark, root, k, **kw):
    return incremental.incremental_quotes(spark, os.path.join(root, "landing", "*"), os.path.join(root, "sink"),
                                          os.path.join(root, "ckpt"), run_ts=dt.datetime(2024, 7, 1 + k), **kw)


def test_a_batch_that_runs_again_after_a_compaction_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    _land(os.path.join(root, "landing", "a"), "x.json", _document("A", [(1717200000 + k * DAY, 1.0) for k in range(30)]))
    _run(spark, root, 0)
    _land(os.path.join(root, "landing", "b"), "y.json", _document("B", [(1717200000 + k * DAY, 2.0) for k in range(30)]))
    assert _run(spark, root, 1).count() == 60
    forget_last_commit(spark, os.path.join(root, "ckpt"))
    assert incremental.compact_increments(spark, os.path.join(root, "sink")).count() == 60
    assert _run(spark, root, 2).count() == 60
    log = CommitLog(spark, os.path.join(root, "sink"))
    assert [e.is_base for e in log.live()] == [True] and len(log.entries()) == 3
    assert log.remove_replaced() == 2 and log.remove_replaced() == 0
    assert incremental.read_quotes(spark, os.path.join(root, "sink")).count() == 60
    # A later correction meets the base; the other bars pass by.
    _land(os.path.join(root, "landing", "c"), "z.json", _document("A", [(1717200000, 9.0)]))
    out = _run(spark, root, 3)
    assert out.count() == 60 and out.filter("ticker = 'A'").orderBy("Date").first()["Close"] == 9.0
    assert incremental.compact_increments(spark, os.path.join(root, "sink")).count() == 60


def test_a_write_without_its_commit_is_not_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _land(os.path.join(root, "landing", "a"), "x.json", _document("A", [(1717200000 + k * DAY, 1.0) for k in range(5)]))
    real = CommitLog.add
    monkeypatch.setattr(CommitLog, "add", lambda self, entry: 1 / 0)  # the driver dies before the commit
    with pytest.raises(Exception):
        _run(spark, root, 0)
    assert incremental.read_quotes(spark, os.path.join(root, "sink")).count() == 0
    monkeypatch.setattr(CommitLog, "add", real)
    assert _run(spark, root, 1).count() == 5


def test_second_of_two_compactions_is_refused(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.add(Entry("batch-s-0", "data/a")) and not log.add(Entry("batch-s-0", "data/b"))
    name = log.next_base()
    assert log.add(Entry(name, "data/c", ["batch-s-0"])) and not log.add(Entry(name, "data/d", ["batch-s-0"]))
    assert [e.folder for e in log.live()] == ["data/c"]
    log.add(Entry("batch-s-1", "data/e"))  # committed while the next base is written: not among its entries
    assert log.add(Entry(log.next_base(), "data/f", [name]))
    assert {e.folder for e in log.live()} == {"data/e", "data/f"}
    assert sorted(f for f in os.listdir(tmp_path / "_commits") if not f.endswith(".crc")) == [
        "base-000000001.json", "base-000000002.json", "batch-s-0.json", "batch-s-1.json"]


def test_report_of_a_batch(spark, tmp_path):
    root = str(tmp_path)
    _land(os.path.join(root, "landing", "a"), "x.json", _document("A", [(1717200000, 1.0), (None, 1.0)]) + "{broken\n")
    _land(os.path.join(root, "landing", "a"), "y.json", '{"results": []}\n{"results": [{"symbol": "C"}]}\n')
    _run(spark, root, 0)
    got = {r["metric"]: r["value"] for r in incremental.ingestion_report(spark, os.path.join(root, "sink")).collect()}
    assert got == {"documents": 4, "ok": 1, "malformed": 1, "no_results": 1, "no_history": 1, "bars": 1}


def _by_month(spark, root, rows):
    t = MonthTable(spark, root, "d", rows.schema)
    return t


def test_month_table_replaces_whole_months_at_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(dt.datetime(2024, m, d), float(m)) for m in (1, 2, 3) for d in (1, 2)] + [(None, 0.0)],
                                 "d timestamp, v double")
    t = _by_month(spark, str(tmp_path), rows)
    assert t.read().count() == 0
    assert t.replace(rows) == ["2024-01", "2024-02", "2024-03", "none"]
    before = t.parts()
    new = rows.filter("month(d) = 2").withColumn("v", F.lit(9.0))
    with pytest.raises(ValueError):
        t.replace(rows, ["2024-02"])  # rows outside the months that are replaced
    assert t.parts() == before
    t.replace(new, ["2024-02", "2024-03"])
    after = t.parts()
    assert set(after) == {"2024-01", "2024-02", "none"} and after["2024-01"] == before["2024-01"] != after["2024-02"]
    assert sorted((r.d.month if r.d else 0, r.v) for r in t.read().collect()) == [(0, 0.0), (1, 1.0), (1, 1.0), (2, 9.0), (2, 9.0)]
    assert all("2024-02" in f for f in t.read(["2024-02"]).inputFiles())
    # A commit that comes in between: of another month it does no harm, of the same month it wins.
    real = MonthTable(spark, str(tmp_path), "d", rows.schema)
    write = t.log.subfolders
    for months, fails in (([4], False), ([2], True)):
        late = rows.filter("month(d) = 1").withColumn("d", F.make_timestamp(F.lit(2024), F.lit(months[0]), F.dayofmonth("d"), F.lit(0), F.lit(0), F.lit(0)))
        monkeypatch.setattr(t.log, "subfolders", lambda folder: real.replace(late) and write(folder))
        if fails:
            with pytest.raises(CommitConflict):
                t.replace(new, ["2024-02"])
        else:
            t.replace(new, ["2024-02"])
        monkeypatch.setattr(t.log, "subfolders", write)
    assert sorted(t.parts()) == ["2024-01", "2024-02", "2024-04", "none"]


def test_refresh_of_states_reads_only_changed_months(spark, tmp_path):
    bars = tb.bars(spark, SF001)
    layer = QuoteLayer(spark, str(tmp_path), bars)
    layer.refresh(bars)
    silver, states = layer.silver.parts(), layer.states.parts()
    month = F.date_format("trade_date", "yyyy-MM")
    assert layer.refresh(bars.filter(month == "1998-02")) == ["1998-02"]
    changed = {m for m, f in layer.silver.parts().items() if silver[m] != f} | {m for m, f in layer.states.parts().items() if states[m] != f}
    assert changed == {"1998-02"}
    read = layer.changed_states(["1998-02"]).inputFiles()
    assert read and all("1998-02" in f for f in read)
    gold = {r.symbol: r for r in layer.gold().collect()}
    for r in equity.equity_performance(bars).collect():
        assert gold[r.symbol].avg_return == pytest.approx(r.avg_return, rel=1e-12) and gold[r.symbol].last_update == r.last_update


@pytest.mark.parametrize("day", ["2000-06-30", "2000-07-01", "2000-08-15", "1996-01-01"])
def test_dashboard_from_states_on_any_day(spark, tmp_path, day):
    """First and last days of months, and a day with few months before it."""
    series = tb.series(spark, SF001)
    layer = SeriesLayer(spark, str(tmp_path), series)
    layer.refresh(series)
    as_of = dt.date.fromisoformat(day)
    got = {(r.idx_type, r.ano_mes): r for r in layer.gold(as_of, sort=False).collect()}
    want = {(r.idx_type, r.ano_mes): r for r in macro.macro_dashboard(series, as_of, sort=False).collect()}
    assert set(got) == set(want) and len(want) > 0
    for k, r in want.items():
        for c in macro.DASHBOARD_COLUMNS:
            a, b = got[k][c], r[c]
            assert a == pytest.approx(b, rel=1e-9, abs=1e-12) if isinstance(b, float) else a == b, (k, c)


@pytest.mark.parametrize("segment", ["day", "hour"])
def test_states_of_intraday_rows(spark, segment):
    rows = tb.event_bars(spark, SF001)
    a = {r.symbol: r for r in equity.month_states(rows, segment=segment).collect()}
    for r in equity.month_states(rows).collect():
        for c in r.asDict():
            assert a[r.symbol][c] == pytest.approx(r[c], rel=1e-9) if isinstance(r[c], float) else a[r.symbol][c] == r[c], c


def test_ranged_returns_of_one_dense_instant(spark):
    """A key that holds nearly all rows, most of them at one instant, null keys, dates and prices."""
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, float(k % 7)) for k in range(3000)] + [("a", t + dt.timedelta(days=k), None if k % 3 else 5.0) for k in range(1, 40)]
    rows += [("b", None, 1.0), ("b", t, 2.0), (None, t, 3.0), (None, t, 4.0), ("c", t, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, trade_date timestamp, close_price double").repartition(7)
    key = lambda r: tuple((x is not None, x) for x in (r.symbol, r.trade_date, r.close_price, r.prev_close, r.daily_return))
    want, got = (sorted(equity.daily_returns(df, method=m).collect(), key=key) for m in ("plain", "ranged"))
    assert got == want
    plan = equity.daily_returns(df, method="ranged")
    assert plan_summary(plan)["nested_loop_joins"] == 0


def test_bucketed_states_exchange_no_rows(spark):
    from tickforge.plans.layer_queries import bucketed_bars
    table = bucketed_bars(spark, tb.bars(spark, SF001), 4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        states = plan_summary(equity.month_states(table, segment="ref_month"))
        assert states["hash_exchanges"] == 0 and states["scans"] == 1
        # Gold adds one exchange, of one row a key and month.
        assert plan_summary(equity.performance_of_states(equity.month_states(table, segment="ref_month")))["hash_exchanges"] == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_quarantine_is_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2.0), (2, None), (None, None)], "k int, v double")
    checks = [quality.Check("has_k", "k is not null"), quality.Check("positive", "v > 0")]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = quality.write_split(rows.mapInArrow(count, rows.schema), checks, str(tmp_path / "rows"))
    assert seen.value == 3
    assert got == {"rows": 3, "quarantine": 2, "failed has_k": 1, "failed positive": 2}
    bad = quality.read_split(rows.schema, spark, str(tmp_path / "rows"), quality.QUARANTINE).collect()
    assert sorted((r.k or 0, r.failed_checks) for r in bad) == [(0, ["has_k", "positive"]), (2, ["positive"])]
    quality.write_split(rows.filter("k = 1"), checks, str(tmp_path / "good"))
    assert quality.read_split(rows.schema, spark, str(tmp_path / "good"), quality.QUARANTINE).count() == 0


def test_refresh_reads_the_landing_once(spark, tmp_path, monkeypatch):
    """Every landed document and series row is read by one pass, reports included."""
    landing = str(tmp_path / "landing")
    pl.bars_to_payloads(tb.bars(spark, "/root/testdata/sf0.001")).drop("segment").write.json(landing)
    docs, rows = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    real = pl.read_quote_payloads

    def counting(acc):
        def count(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return count

    def read(*args):
        out = real(*args)
        return out.mapInArrow(counting(docs), out.schema)

    monkeypatch.setattr(medallion.pl, "read_quote_payloads", read)
    series = spark.createDataFrame([(1178, f"{d:02d}/01/2001", "1.5") for d in range(1, 29)] + [(9, "x", "y")], "code int, data string, valor string")
    got = medallion.refresh_layers(spark, landing, series.mapInArrow(counting(rows), series.schema), '{"selic": 1178}', str(tmp_path / "out"),
                                   "01/01/1990", "01/08/2001", as_of="2001-08-01", tickers=["1-URGENT", "NONE1"])
    assert docs.value == sum(got["quote_documents"].values()) > 0 and rows.value == 29
    assert got["quote_sources"] == {"1-URGENT": "ok", "NONE1": "no_data"} and got["series_dropped"] == {"9": [1, 1], "1178": [28, 0]}
    assert set(got["bronze_nulls"]["bronze_quotes"].values()) == {0}


def test_source_opens_only_the_files_of_the_tickers_asked_for(spark, tmp_path):
    for name in ("PETR4.json", "vale3.SA.json", "itub4/part-0.json", "symbol=ABEV3/part-0.json"):
        _land(str((tmp_path / name).parent), os.path.basename(name), _document(None, [(1717200000, 3.0), (None, "x")]) + "{broken\n[]\n\n")
    os.makedirs(tmp_path / "_hidden"), os.makedirs(tmp_path / "EMPTY")
    quote_source.register(spark)
    load = lambda: spark.read.format("quote_payloads").option("path", str(tmp_path)).load()
    got = {(r.ticker, r.epoch, r.close) for r in load().collect()}
    assert got == {(t, *v) for t in ("PETR4", "VALE3", "ITUB4", "ABEV3") for v in ((1717200000.0, 3.0), (None, None))}
    assert load().rdd.getNumPartitions() == 4
    # A file that cannot be opened, of a ticker that nobody asks for.
    os.rename(tmp_path / "PETR4.json", tmp_path / "kept"), os.symlink("/nonexistent", tmp_path / "itub4" / "gone.json")
    some = load().filter("ticker in ('VALE3', 'ABEV3') and close > 1")
    assert some.rdd.getNumPartitions() == 2 and {r.ticker for r in some.collect()} == {"VALE3", "ABEV3"}
    assert load().filter("ticker = 'NONE1'").count() == 0


def test_coverage_merges_any_states(spark):
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1 + k % 4, 1 + k % 20)) for k in range(500)] * 2 + [(None, dt.datetime(2024, 1, 1)), (3, None)],
                                 "k long, d timestamp")
    first = coverage.key_numbers(None, rows.filter("k < 100"), "k").cache()
    numbers = coverage.key_numbers(first, rows, "k").cache()
    assert numbers.count() == numbers.select("number").distinct().count() == 500
    assert numbers.join(first, ["key", "number"]).count() == 100  # numbers stay as they were given
    states = coverage.coverage_states(rows, numbers, "k", "d")
    got = coverage.coverage_of_states(states.union(states.limit(0))).first()
    want = profile.coverage(rows, "k", "d").first()
    assert tuple(got) == tuple(want)
    assert tuple(coverage.coverage_of_states(states.limit(0)).first()) == (0, 0, None, None)


def test_update_goes_on_after_any_crash(spark, tmp_path, monkeypatch):
    """Cut off after bronze, and after silver: the next run makes good what is missing, and touches only those months."""
    from tickforge.plans import gold_states
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")

    def run():
        return gold_states.update_quotes(spark, os.path.join(landing, "*"), root)

    days = lambda m, n: [(int(dt.datetime(2024, m, d, tzinfo=dt.timezone.utc).timestamp()), float(d)) for d in range(1, n)]
    _land(os.path.join(landing, "a"), "x.json", _document("A", days(1, 20) + days(2, 20)))
    real = gold_states.QuoteLayer.refresh
    monkeypatch.setattr(gold_states.QuoteLayer, "refresh", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(gold_states.QuoteLayer, "refresh", real)
    assert run()["months"] == ["2024-01", "2024-02"]
    layer = QuoteLayer(spark, os.path.join(root, "quotes"), gold_states.schemas.empty_frame(spark, gold_states.schemas.SILVER_EQUITY))
    before = layer.silver.parts()
    _land(os.path.join(landing, "b"), "y.json", _document("A", days(2, 3) + days(3, 9)) + _document("B", days(3, 5)))
    catch_up = gold_states.QuoteLayer.catch_up
    monkeypatch.setattr(gold_states.QuoteLayer, "catch_up", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(gold_states.QuoteLayer, "catch_up", catch_up)
    got = run()  # nothing new has landed; the states are behind
    assert got["months"] == [] and got["gold_equity"] == {"rows": 2}
    after = layer.silver.parts()
    assert {m for m in after if before.get(m) != after[m]} == {"2024-02", "2024-03"}
    gold = {r.symbol: r for r in spark.read.parquet(os.path.join(root, "gold_equity")).collect()}
    for r in equity.equity_performance(layer.silver.read()).collect():
        assert gold[r.symbol].avg_return == pytest.approx(r.avg_return) and gold[r.symbol].avg_price == pytest.approx(r.avg_price)
    assert layer.silver.read().count() == 38 + 8 + 4


def test_cli_update(spark, tmp_path):
    from tickforge.__main__ import main
    _land(str(tmp_path / "landing" / "a"), "PETR4.json", _document(None, [(1717200000, 3.0), (1717286400, 4.0)]))
    got = main(["update", "--quotes", str(tmp_path / "landing" / "*"), "--root", str(tmp_path / "root"), "--compact"])
    assert got["months"] == ["2024-06"] and got["gold_equity"] == {"rows": 1}
    assert [m["bars"] for m in got["ingested"].values()] == [2]
    assert main(["update", "--quotes", str(tmp_path / "landing" / "*"), "--root", str(tmp_path / "root")])["ingested"] == {}
