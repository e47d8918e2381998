import datetime as dt

import pytest
from pyspark.sql import Observation

from tickforge import schemas
from tickforge.operators import quality
from tickforge.sources import config as cfg


@pytest.fixture(scope="module")
def rows(spark):
    data = [(dt.datetime(2024, 1, 2), "A", 1.0), (None, "A", 2.0), (dt.datetime(2024, 1, 3), "A", None)]
    return spark.createDataFrame(data, "trade_date timestamp, symbol string, close_price double")


def test_report(rows):
    rep = {r.check: (r.passed, r.failed) for r in quality.check_report(rows, quality.SILVER_EQUITY_CHECKS).collect()}
    assert rep == {"valid_close": (2, 1), "valid_date": (2, 1)}


def test_modes(rows):
    obs = Observation("t")
    out = quality.apply_checks(rows, quality.SILVER_EQUITY_CHECKS, "warn", obs)
    assert out.count() == 3
    assert obs.get == {"rows": 3, "valid_close": 1, "valid_date": 1}
    assert quality.apply_checks(rows, quality.SILVER_EQUITY_CHECKS, "drop").count() == 1
    with pytest.raises(Exception):
        quality.apply_checks(rows, quality.SILVER_EQUITY_CHECKS, "fail").collect()


def test_not_null_checks():
    names = [c.name for c in quality.not_null_checks(schemas.BRONZE_QUOTES)]
    assert names == ["Date_not_null", "ticker_not_null", "ingestion_timestamp_not_null"]


def test_source_status(spark):
    bars = spark.createDataFrame(
        [("OK", dt.datetime(2024, 6, 1), 1.0), ("OLD", dt.datetime(2023, 1, 1), 1.0),
         ("BAD", dt.datetime(2024, 6, 1), None), ("BAD", dt.datetime(2024, 5, 30), float("nan"))],
        "symbol string, trade_date timestamp, close_price double")
    req = cfg.ticker_list(spark, "OK,OLD,BAD,NONE")
    out = {r.symbol: r.status for r in quality.source_status(req, bars, "01/05/2024", "01/06/2024").collect()}
    assert out == {"OK": "ok", "OLD": "none_in_period", "BAD": "all_invalid", "NONE": "no_data"}


def test_registry():
    assert schemas.table_name("prata", "tb_mkt_eqt_day") == "silver.tb_mkt_eqt_day"
    assert schemas.table_name("prata", "tb_mkt_eqt_day", database="curated") == "curated.tb_mkt_eqt_day"
    assert schemas.table_name("silver", "tb_mkt_eqt_day", with_schema=False) == "tb_mkt_eqt_day"
    assert schemas.table_spec("ouro", "tb_mkt_idx_dash").alias == "Dashboard Macro"
    with pytest.raises(ValueError):
        schemas.table_name("platinum", "x")
    with pytest.raises(ValueError):
        schemas.table_name("bronze", "nope")


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "Date int")
    with pytest.raises(ValueError, match="Close"):
        schemas.require_columns(df, schemas.BRONZE_QUOTES)
    assert schemas.empty_frame(spark, schemas.BRONZE_SERIES).count() == 0


def test_cluster_settings():
    from tickforge.session import cluster_settings
    s = cluster_settings(100 * 1024 ** 4, cores=4000)
    assert int(s["spark.sql.shuffle.partitions"]) == 40_000  # bounded, whatever the input
    assert s["spark.sql.files.maxPartitionBytes"] == "512m"
    assert int(cluster_settings(10, cores=8)["spark.sql.shuffle.partitions"]) == 16
    assert int(cluster_settings(1024 ** 4, cores=8)["spark.sql.shuffle.partitions"]) == 410


def test_checkpoint_folder_is_needed_off_local():
    from types import SimpleNamespace
    from tickforge.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_contract_diff(spark):
    from tickforge.operators import equity
    bars = spark.createDataFrame([("a", dt.date(2024, 1, 2), 1.0, 1.0)],
                                 "symbol string, trade_date date, close_price double, volume double")
    diff = schemas.contract_diff(equity.equity_performance(bars), schemas.table_spec("ouro", "tb_mkt_eqt_perf"))
    assert diff == {"missing": ["monthly_return"], "extra": ["avg_return"]}
