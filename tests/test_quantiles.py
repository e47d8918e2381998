import numpy as np
import pytest

from tickforge.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("final_rows", [100_000, 50, 5])
def test_exact_quantiles_match_numpy(spark, final_rows):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(size=900), np.full(300, 2.5), rng.integers(0, 5, 200).astype(float)])
    b = rng.exponential(size=37)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.k, r.p): r.quantile for r in
           exact_quantiles(df, "v", probs, ["k"], final_rows=final_rows).collect()}
    for key, arr in (("a", a), ("b", b), ("c", np.array([4.0]))):
        for p in probs:
            assert got[(key, p)] == pytest.approx(np.quantile(arr, p), rel=1e-12, abs=1e-12)


def test_ungrouped(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    got = {r.p: r.quantile for r in exact_quantiles(df, "v", [0.25, 0.5], final_rows=10).collect()}
    assert got == {0.25: 25.0, 0.5: 50.0}


@pytest.mark.parametrize("final_rows", [500])
def test_selection_matches_duckdb_on_test_tables(spark, final_rows):
    """Force selection by digits on real data and compare with DuckDB."""
    from tests.conftest import SF001
    from tests.oracle import duck
    from tickforge.sources import tables as tb
    bars = tb.bars(spark, SF001)
    got = {(r.symbol, r.p): r.quantile for r in
           exact_quantiles(bars, "close_price", [0.1, 0.5, 0.99], ["symbol"], final_rows=final_rows).collect()}
    con = duck(SF001)
    from tickforge.sources.tables import BARS_SQL
    ref = con.execute(f"""with bars as ({BARS_SQL})
        select symbol, quantile_cont(close_price, 0.1), quantile_cont(close_price, 0.5),
               quantile_cont(close_price, 0.99) from bars group by symbol""").fetchall()
    assert len(got) == 3 * len(ref)
    for sym, a, b, c in ref:
        for p, v in ((0.1, a), (0.5, b), (0.99, c)):
            assert got[(sym, p)] == pytest.approx(v, rel=1e-12)


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1074 * 3, 2.0 ** -1022, np.nextafter(2.0 ** -1022, 0), 1.0, np.nextafter(1.0, 0),
            np.nextafter(1.0, 2), 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, -0.1, 3.0, 2.9999999999999996]


def test_ordered_bits_are_the_binary_order(spark):
    """Exponent and fraction, as the bytes of the double have them, at every power of two and its neighbours."""
    from pyspark.sql import functions as F

    from tickforge.operators.quantiles import ordered_bits
    powers = [2.0 ** k for k in range(-1074, 1024)]
    values = EXTREMES + powers + [np.nextafter(p, 0) for p in powers] + [-np.nextafter(p, np.inf) for p in powers[:-1]]
    values += np.random.default_rng(1).normal(size=500).tolist()
    values = [float(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b"))
    for r in df.collect():
        bits = int(np.array([abs(r["v"])]).view(np.int64)[0])
        assert r["b"] == (-bits if r["v"] < 0 else bits), r["v"]


def test_four_rounds_whatever_the_skew(spark, monkeypatch):
    from tickforge.operators import quantiles
    rounds = []
    real = quantiles.written
    monkeypatch.setattr(quantiles, "written", lambda df, name: rounds.append(name) or real(df, name))
    values = [1.0] * 400 + [1.0 + k * 2.0 ** -52 for k in range(40)] + [10.0 ** k for k in range(-300, 300, 7)] + [-3.5] * 60
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0)] * 3, "k string, v double")
    got = {(r.k, r.p): r.quantile for r in exact_quantiles(df, "v", [0.1, 0.5, 0.75, 0.9], ["k"], final_rows=10).collect()}
    for p in (0.1, 0.5, 0.75, 0.9):
        assert got["a", p] == pytest.approx(np.quantile(values, p), rel=1e-12) and got["b", p] == 2.0
    assert rounds.count("quantile-state") == 4 and rounds.count("quantile-rows") == 1
