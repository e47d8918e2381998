"""Edge rows every cleaning step must get right (FIXTURES.md section 3)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickforge.operators import clean, silver
from tickforge.sources import config as cfg
from tickforge.sources import payload as pl
from tickforge.sources import series as sr


def _payload_df(spark, docs):
    return pl.parse_payload_text(spark.createDataFrame([(d,) for d in docs], "body string"))


def test_end_day_midnight_rule(spark):
    doc = json.dumps({"results": [{"symbol": "PETR4", "historicalDataPrice": [
        {"date": 1717246800, "open": 1, "high": 1, "low": 1, "close": 1, "volume": 1},   # 13:00 UTC
        {"date": 1717200000, "open": 2, "high": 2, "low": 2, "close": 2, "volume": 2},   # midnight
    ]}]})
    rows = pl.quote_rows(_payload_df(spark, [doc]))
    kept = clean.date_window(rows, "01/05/2024", "01/06/2024", "Date").collect()
    assert [r.Close for r in kept] == [2.0]


def test_span_clamped_to_90_days(spark):
    out = spark.range(1).select(
        __import__("tickforge.functions.dates", fromlist=["x"]).clamp_start(
            "01/01/2024", "01/06/2024", 90).alias("s")).first().s
    assert out == dt.date(2024, 3, 3)


def test_null_fill_and_bad_numbers(spark):
    rows = [(dt.datetime(2024, 1, 2), None, "x", "NaN", "1.5", "T"),
            (None, 1.0, "1", "1", "1", "T")]
    df = spark.createDataFrame(rows, "Date timestamp, Open double, High string, Close string, Volume string, ticker string")
    parity = clean.clean_quotes(df, numeric=["Open", "High", "Close", "Volume"]).collect()
    assert len(parity) == 1  # missing date dropped
    r = parity[0]
    assert (r.Open, r.High, r.Close, r.Volume) == (0.0, 0.0, 0.0, 1.5)
    keep = clean.clean_quotes(df, numeric=["Open", "High", "Close", "Volume"], null_fill=None).first()
    assert keep.Open is None and keep.High is None and keep.Close is None


def test_payload_shapes(spark):
    docs = [json.dumps({"results": []}),
            json.dumps({"results": [{"symbol": "A"}]}),
            "{not json",
            json.dumps({"results": [{"symbol": "petr4.SA", "historicalDataPrice": [
                {"date": 1704153600, "open": 1, "high": 2, "low": 0.5, "close": None, "volume": 10}]}]})]
    payloads = _payload_df(spark, docs)
    rows = pl.quote_rows(payloads).collect()
    assert len(rows) == 1 and rows[0].ticker == "PETR4" and rows[0].Close is None
    assert rows[0].Date == dt.datetime(2024, 1, 2)
    outcomes = sorted(r.outcome for r in pl.payload_outcome(payloads).collect())
    assert outcomes == ["malformed", "no_history", "no_results", "ok"]


def test_bad_series_values_counted(spark):
    rows = [("02/01/2024", "1,5", "selic"), ("03/01/2024", "x", "selic"), ("31/02/2024", "2", "ipca"),
            ("04/01/2024", "3", None)]
    df = spark.createDataFrame(rows, "data string, valor string, serie string")
    cleaned = clean.clean_series(df, date_fmt="d/M/yyyy").collect()
    assert sorted((r.serie, r.valor) for r in cleaned) == [("NA", 3.0)]
    dropped = {r.serie: r.rows_dropped for r in clean.dropped_per_series(df, date_fmt="d/M/yyyy").collect()}
    assert dropped == {"selic": 2, "ipca": 1, None: 0}


def test_ticker_suffix_and_list(spark):
    t = [r.symbol for r in cfg.ticker_list(spark, " A, ,B,petr4.SA,vale3.sa").orderBy("position").collect()]
    assert t == ["A", "B", "PETR4", "VALE3.SA"]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Stock Splits` int, Date int")
    assert silver.normalise_columns(df).columns == ["stock_splits", "date"]
    with pytest.raises(ValueError):
        silver.normalise_columns(spark.createDataFrame([(1, 2)], "Date int, `date ` int").toDF("Date", "date"))


def test_series_map_unknown_code(spark):
    landed = spark.createDataFrame([(1178, "02/01/2024", "10"), (99, "02/01/2024", "5")],
                                   "code int, data string, valor string")
    out = {r.code: r.serie for r in sr.label_series(sr.typed_series(landed),
                                                    sr.series_map(spark, '{"selic": 1178}')).collect()}
    assert out == {1178: "selic", 99: "99"}


def test_silver_macro_frequency(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "1.0", "ipca"), (dt.datetime(2024, 1, 1), "2", "selic")],
                               "data timestamp, valor string, serie string")
    out = {r.idx_type: r.frequency for r in silver.silver_macro(df, {"ipca": "M"}).collect()}
    assert out == {"ipca": "M", "selic": "D"}


def test_ticker_from_file_name(spark, tmp_path):
    (tmp_path / "vale3.SA.json").write_text(json.dumps({"results": [{"historicalDataPrice": [
        {"date": 1704153600, "open": 1, "high": 1, "low": 1, "close": 1, "volume": 1}]}]}) + "\n")
    (tmp_path / "ITUB4.json").write_text(json.dumps({"results": [{"symbol": "ITUB4", "historicalDataPrice": [
        {"date": 1704153600, "open": 2, "high": 2, "low": 2, "close": 2, "volume": 2}]}]}) + "\n")
    p = pl.read_quote_payloads(spark, str(tmp_path))
    label = F.coalesce(pl.payload_ticker(), pl.ticker_from_file("source_file"))
    got = sorted((r.ticker, r.Close) for r in pl.quote_rows(p, label).collect())
    assert got == [("ITUB4", 2.0), ("VALE3", 1.0)]


def test_ticker_from_file_patterns(spark):
    paths = ["s3://b/landing/PETR4.json", "/x/vale3.SA.json", "/x/ITUB4.json.gz", "/x/BBAS3",
             "/x/part-00000-abc.json", None]
    df = spark.createDataFrame([(p,) for p in paths], "source_file string")
    got = [r.t for r in df.select(pl.ticker_from_file("source_file").alias("t")).collect()]
    assert got == ["PETR4", "vale3.SA", "ITUB4", "BBAS3", None, None]


def test_small_helpers(spark, tmp_path):
    from tickforge.operators import profile
    from tickforge.sources import tables as tb
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    out = clean.add_constants(df, {"Dividends": 0.0, "Stock_Splits": 0.0})
    assert out.columns == ["n", "s", "Dividends", "Stock_Splits"]
    assert [r.n for r in profile.sorted_rows(df, ["n"]).collect()] == [1, 2]
    assert [r.s for r in profile.rows_of(df, "n", 2).collect()] == ["b"]
    df.write.parquet(str(tmp_path / "t"))
    assert tb.read_layer(spark, "unused", str(tmp_path / "t")).count() == 2
    df.createOrReplaceTempView("layer_view")
    assert tb.read_layer(spark, "layer_view").count() == 2


def test_payload_outcome_with_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        docs = [json.dumps({"results": []}), json.dumps({"results": [{"symbol": "A"}]})]
        got = sorted((r.outcome, r.n_bars) for r in pl.payload_outcome(_payload_df(spark, docs)).collect())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == [("no_history", 0), ("no_results", 0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_reformat_raises(spark, ansi):
    from tickforge.functions.dates import reformat_date_text
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ok = spark.createDataFrame([("02/01/2024",), (None,)], "d string")
        assert [r.x for r in ok.select(reformat_date_text("d", strict=True).alias("x")).collect()] == ["2024-01-02", None]
        bad = spark.createDataFrame([("2024-01-02",)], "d string")
        with pytest.raises(Exception):
            bad.select(reformat_date_text("d", strict=True).alias("x")).collect()
        assert bad.select(reformat_date_text("d").alias("x")).first().x is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
