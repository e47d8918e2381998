"""Landing files -> bronze -> silver -> gold, table writes, incremental runs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import equity, layout
from tickforge.plans import medallion
from tickforge.sources import payload as pl
from tickforge.sources import tables as tb
from tickforge.streaming.incremental import incremental_quotes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="landing-"), "docs")
    pl.bars_to_payloads(tb.bars(spark, SF)).drop("segment").write.json(path)
    return path


def test_layers_end_to_end(spark, landing):
    bars = tb.bars(spark, SF)
    bronze = medallion.bronze_quotes(spark, landing, "01/01/1990", "01/08/2001", max_days=None,
                                     run_ts=dt.datetime(2024, 1, 1))
    assert bronze.schema.fieldNames() == schemas.BRONZE_QUOTES.fieldNames()
    assert bronze.count() == bars.count()
    obs = Observation("silver")
    silver_df = medallion.silver_quotes(bronze, "warn", obs)
    gold = {r.symbol: r for r in medallion.gold_equity(silver_df).collect()}
    assert obs.get["valid_close"] == 0 and obs.get["rows"] == bars.count()
    ref = {r.symbol: r for r in equity.equity_performance(bars).collect()}
    assert set(gold) == set(ref)
    for k, r in ref.items():
        assert gold[k].avg_price == pytest.approx(r.avg_price)
        assert gold[k].avg_return == pytest.approx(r.avg_return)
        assert gold[k].volatility == pytest.approx(r.volatility)


def test_bronze_window_and_tickers(spark, landing):
    tickers = spark.createDataFrame([("1-URGENT",)], "symbol string")
    b = medallion.bronze_quotes(spark, landing, "01/01/2001", "01/08/2001", tickers=tickers)
    rows = b.select("ticker", "Date").collect()
    assert {r.ticker for r in rows} == {"1-URGENT"}
    assert min(r.Date for r in rows) < dt.datetime(2001, 5, 3)  # the whole span by default
    cut = medallion.bronze_quotes(spark, landing, "01/01/2001", "01/08/2001", max_days=90)
    assert cut.agg(F.min("Date")).first()[0] >= dt.datetime(2001, 5, 3)


def test_bronze_on_error_empty(spark):
    out = medallion.bronze_quotes(spark, "/nonexistent/landing", "01/01/2001", "01/08/2001",
                                  on_error="empty")
    assert out.count() == 0 and out.schema == schemas.BRONZE_QUOTES
    with pytest.raises(Exception):
        medallion.bronze_quotes(spark, "/nonexistent/landing", "01/01/2001", "01/08/2001").count()


def test_write_table_path_and_catalog(spark):
    root = tempfile.mkdtemp(prefix="tables-")
    bars = tb.bars(spark, SF)
    obs = layout.write_table(layout.partition_by_key(bars, "symbol", "trade_date"),
                             path=os.path.join(root, "bars"))
    assert obs.get["rows"] == bars.count()
    spec = schemas.table_spec("ouro", "tb_mkt_eqt_perf")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{os.path.join(root, 'marts')}'")
    layout.write_table(equity.equity_performance(bars), spec=spec, database="marts")
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {spec.name_in('marts')}").collect()}
    assert props["quality"] == "gold"
    assert spark.table(spec.name_in("marts")).count() == 5


@pytest.mark.parametrize("max_files", [None, 1])
def test_incremental_takes_only_new_files(spark, max_files):
    root = tempfile.mkdtemp(prefix="inc-")
    landing, sink, ckpt = (os.path.join(root, p) for p in ("landing", "sink", "ckpt"))
    docs = pl.bars_to_payloads(tb.bars(spark, SF), overlap_days=5).drop("segment")
    docs.filter(F.get("results", 0)["historicalDataPrice"][0]["date"].cast("long") < 946684800) \
        .write.json(os.path.join(landing, "a"))
    first = incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=max_files).count()
    docs.filter(F.get("results", 0)["historicalDataPrice"][0]["date"].cast("long") >= 946684800) \
        .write.json(os.path.join(landing, "b"))
    out = incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=max_files)
    n_bars = tb.bars(spark, SF).count()
    assert 0 < first < n_bars
    assert out.count() == n_bars
    assert out.select("ticker", "Date").distinct().count() == n_bars


def test_quote_window():
    assert medallion.quote_window(dt.date(2024, 5, 31)) == ("29/02/2024", "31/05/2024")
    assert medallion.quote_window(dt.date(2024, 1, 15)) == ("15/10/2023", "15/01/2024")


def test_refresh_layers(spark, landing):
    root = tempfile.mkdtemp(prefix="layers-")
    s = tb.series(spark, SF)
    code = F.when(F.col("idx_type") == "R", 1178).when(F.col("idx_type") == "A", 433).otherwise(12)
    landed = s.select(code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
                      F.col("idx_value").cast("string").alias("valor"))
    got = medallion.refresh_layers(spark, landing, landed, '{"selic": 1178, "ipca": 433}', root,
                                   "01/01/1990", "01/08/2001", as_of="2001-11-04", max_days=None)
    n_bars, n_series = tb.bars(spark, SF).count(), s.count()
    assert got["bronze_quotes"]["rows"] == got["silver_quotes"]["rows"] == n_bars
    named = s.filter("idx_type in ('R', 'A')").count()  # code 12 is not in the map: nobody asked for it
    assert 0 < named < n_series
    assert got["bronze_series"]["rows"] == got["silver_series"]["rows"] == named
    assert got["quote_documents"] == {"ok": pl.bars_to_payloads(tb.bars(spark, SF)).count()}
    assert got["series_dropped"]["12"][1] == 0 and set(got["series_dropped"]) == {"12", "433", "1178"}
    assert not any(got["bronze_nulls"]["bronze_quotes"].values())
    sq = spark.read.parquet(os.path.join(root, "silver_quotes"))
    assert "PartitionFilters: [isnotnull(ref_month" in sq.filter("ref_month >= '2001-01'")._jdf.queryExecution().toString()
    assert got["silver_quotes_checks"]["valid_close"] == 0
    assert got["gold_equity"]["rows"] == 5
    gm = spark.read.parquet(os.path.join(root, "gold_macro"))
    assert {r.idx_type for r in gm.select("idx_type").distinct().collect()} == {"selic", "ipca"}
    assert gm.columns == ["idx_type", "ano", "mes", "ano_mes", "media_mensal", "minimo_mensal",
                          "maximo_mensal", "variacao_mes_anterior", "primeira_data_mes",
                          "ultima_data_mes", "num_medicoes", "last_update", "trend_6m"]


def test_latest_per_key_keeps_latest(spark):
    from tickforge.operators.layout import latest_per_key
    rows = [("A", 1, 10.0, dt.datetime(2024, 1, 1)), ("A", 1, 11.0, dt.datetime(2024, 1, 2)),
            ("A", 2, 5.0, dt.datetime(2024, 1, 1)), ("B", 1, None, dt.datetime(2024, 1, 3)),
            ("B", 1, 7.0, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "k string, d int, v double, ingestion_timestamp timestamp")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k", "d"]).collect())
    assert got == [("A", 1, 11.0, dt.datetime(2024, 1, 2)), ("A", 2, 5.0, dt.datetime(2024, 1, 1)),
                   ("B", 1, None, dt.datetime(2024, 1, 3))]
    # A row without a stamp is kept if it is the only one, and loses to any other; ties are settled.
    rows = [("A", 1, 1.0, None), ("B", 1, 2.0, None), ("B", 1, 3.0, dt.datetime(2024, 1, 1)),
            ("C", None, 5.0, None), ("C", None, 6.0, None)]
    df = spark.createDataFrame(rows, df.schema).repartition(3)
    got = sorted((tuple(r)[:3] for r in latest_per_key(df, ["k", "d"]).collect()), key=str)
    assert got == [("A", 1, 1.0), ("B", 1, 3.0), ("C", None, 6.0)]


def test_bronze_series_window(spark):
    landed = spark.createDataFrame([(1178, "31/12/2019", "1"), (1178, "01/01/2020", "2"),
                                    (433, "15/03/2024", "3"), (433, "16/03/2024", "4")],
                                   "code int, data string, valor string")
    out = medallion.bronze_series(spark, landed, '{"selic": 1178, "ipca": 433}',
                                  dt.datetime(2024, 1, 1), start="01/01/2020", end="15/03/2024")
    assert sorted((r.serie, r.valor) for r in out.collect()) == [("ipca", 3.0), ("selic", 2.0)]


def _document(sym, bars, extra=""):
    import json
    doc = {"results": [{"historicalDataPrice": [
        {"date": e, "open": c, "high": c, "low": c, "close": c, "volume": 1} for e, c in bars]}]}
    if sym:
        doc["results"][0]["symbol"] = sym
    return json.dumps(doc) + extra + "\n"


def _land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.mark.parametrize("max_files", [None, 1])
def test_incremental_loses_no_late_bar(spark, max_files):
    root = tempfile.mkdtemp(prefix="late-")
    landing, sink, ckpt = (os.path.join(root, p) for p in ("landing", "sink", "ckpt"))
    day = 86400
    def run(k):
        return incremental_quotes(spark, os.path.join(landing, "*"), sink, ckpt, max_files_per_trigger=max_files,
                                  run_ts=dt.datetime(2024, 7, 1 + k))
    _land(os.path.join(landing, "a"), "x.json", _document("A", [(1717200000 + k * day, 1.0) for k in range(90)]))
    assert run(0).count() == 90
    # A new ticker with old bars, files without a symbol (named by their file), a correction, a missing date.
    _land(os.path.join(landing, "b"), "y.json", _document("B", [(1680000000 + k * day, 2.0) for k in range(90)]))
    _land(os.path.join(landing, "b"), "PETR4.json", _document(None, [(1717200000 + k * day, 3.0) for k in range(3)]))
    _land(os.path.join(landing, "b"), "VALE3.SA.json", _document(None, [(1717200000 + k * day, 4.0) for k in range(3)]))
    _land(os.path.join(landing, "b"), "z.json", _document("A", [(1717200000, 9.0), (None, 8.0)]))
    out = run(1)
    got = {(r.ticker, r.n) for r in out.groupBy("ticker").agg(F.count("*").alias("n")).collect()}
    assert got == {("A", 90), ("B", 90), ("PETR4", 3), ("VALE3", 3)}
    assert out.schema.fieldNames() == schemas.BRONZE_QUOTES.fieldNames()
    first = out.filter("ticker = 'A'").orderBy("Date").first()
    assert first.Close == 9.0 and first.ingestion_timestamp == dt.datetime(2024, 7, 2)
    from tickforge.streaming.incremental import compact_increments
    whole = sorted(map(tuple, out.collect()))
    folded = compact_increments(spark, sink)
    assert sorted(map(tuple, folded.collect())) == whole


def test_incremental_with_nothing_landed(spark):
    root = tempfile.mkdtemp(prefix="none-")
    os.makedirs(os.path.join(root, "landing", "a"))
    out = incremental_quotes(spark, os.path.join(root, "landing", "*"), os.path.join(root, "s"), os.path.join(root, "c"))
    assert out.count() == 0


def test_overlaps_count_once_and_old_spans_are_kept(spark):
    bars = tb.bars(spark, SF)
    docs = pl.bars_to_payloads(bars, overlap_days=5)
    bronze = medallion.bronze_quotes(spark, docs, "01/01/1990", "01/08/2001")
    assert bronze.count() == bars.count()  # neither doubled nor cut to the last days


def test_multi_line_and_broken_documents(spark):
    root = tempfile.mkdtemp(prefix="multi-")
    _land(root, "PETR4.json", _document(None, [(1717200000, 3.0)]).replace(",", ",\n  "))
    _land(root, "VALE3.json", "{\n \"results\": [")
    rows = medallion.bronze_quotes(spark, root, "01/01/2024", "31/12/2024", multi_line=True)
    assert [(r.ticker, r.Close) for r in rows.collect()] == [("PETR4", 3.0)]
    per_doc = pl.payload_outcome(pl.read_quote_payloads(spark, root, True),
                                 F.coalesce(pl.payload_ticker(), pl.ticker_from_file()))
    assert {(r.ticker, r.outcome) for r in per_doc.collect()} == {("PETR4", "ok"), ("VALE3", "malformed")}


def test_refresh_reports_requested_tickers_and_uses_the_catalog(spark):
    root = tempfile.mkdtemp(prefix="cat-")
    landing = os.path.join(root, "landing")
    _land(landing, "PETR4.json", _document(None, [(1717200000, 3.0), (1717286400, 4.0)]))
    _land(landing, "VALE3.json", "{broken")
    _land(landing, "XXXX9.json", _document("XXXX9", [(1717200000, 3.0)]))
    for db in ("raw", "curated", "marts2"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(root, db)}'")
    landed = spark.createDataFrame([(1178, "02/01/2019", "1"), (1178, "02/01/2024", "x"), (1178, "03/01/2024", "2"),
                                    (77, "03/01/2024", "2")], "code int, data string, valor string")
    dbs = {"bronze": "raw", "prata": "curated", "ouro": "marts2"}
    got = medallion.refresh_layers(spark, landing, landed, '{"selic": 1178}', None, "01/01/2024", "31/12/2024",
                                   as_of="2024-12-31", tickers=["petr4.SA", "VALE3", "NONE1"], series_start="01/01/2020",
                                   null_fill=None, databases=dbs)
    assert got["quote_sources"] == {"PETR4": "ok", "VALE3": "malformed", "NONE1": "no_data"}
    assert got["quote_documents"] == {"ok": 2, "malformed": 1}
    assert got["bronze_quotes"]["rows"] == 2 and got["bronze_series"]["rows"] == 1
    assert got["series_dropped"] == {"1178": [3, 1], "77": [1, 0]}
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES curated.tb_mkt_eqt_day").collect()}
    assert props["quality"] == "silver"
    assert spark.table("marts2.tb_mkt_eqt_perf").count() == 1


def test_refresh_layers_drop_mode_does_not_wait_for_metrics(spark, landing):
    root = tempfile.mkdtemp(prefix="layers-drop-")
    landed = spark.createDataFrame([(1178, "02/01/2001", "1.5")], "code int, data string, valor string")
    got = medallion.refresh_layers(spark, landing, landed, '{"selic": 1178}', root,
                                   "01/01/2001", "01/08/2001", as_of="2001-08-01",
                                   check_mode="drop")
    assert "silver_quotes_checks" not in got
    assert got["silver_quotes"]["rows"] == got["bronze_quotes"]["rows"]
    assert got["gold_macro"]["rows"] == 1


def test_cli_refresh(spark, landing):
    from tickforge.__main__ import main
    root = tempfile.mkdtemp(prefix="cli-")
    series_csv = os.path.join(root, "series_csv")
    code = F.when(F.col("idx_type") == "R", 1178).when(F.col("idx_type") == "A", 433).otherwise(12)
    tb.series(spark, SF).select(code.alias("code"), F.date_format("ref_date", "dd/MM/yyyy").alias("data"),
                                F.col("idx_value").cast("string").alias("valor")) \
        .write.option("header", True).csv(series_csv)
    got = main(["refresh", "--quotes", landing, "--series", series_csv, "--out", os.path.join(root, "out"),
                "--as-of", "2001-08-01", "--start", "01/01/1990", "--series-start", "01/01/1990"])
    assert got["gold_equity"]["rows"] == 5
    assert got["bronze_series"]["rows"] == tb.series(spark, SF).count()  # all codes are in the default map


def test_cli_plans(spark):
    from tickforge.__main__ import main
    got = main(["plans", "--data", SF])
    assert got["equity_perf"]["scans"] == 1 and "sort_merge_joins" not in got["equity_perf"]
    assert all("nested_loop_joins" not in v and "python_udfs" not in v for v in got.values())


def test_bucketed_catalog_write_avoids_shuffle(spark):
    from tickforge.plans.inspect import plan_summary
    root = tempfile.mkdtemp(prefix="bucketed-")
    spec = schemas.table_spec("prata", "tb_mkt_eqt_day")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{os.path.join(root, 'bucketed')}'")
    bars = tb.bars(spark, SF)
    layout.write_table(bars, spec=spec, bucket_by=(4, ["symbol"]), database="bucketed")
    t = spark.table(spec.name_in("bucketed"))
    assert t.count() == bars.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        agg = t.groupBy("symbol").agg(F.max("trade_date"))
        assert plan_summary(agg)["hash_exchanges"] == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
