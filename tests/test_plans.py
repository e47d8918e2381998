"""Plan-shape checks: scans, joins, sorts, pushdown, partial group limits."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tickforge.operators import equity, macro, profile
from tickforge.sources import tables as tb
from tests.conftest import SF001


def plan(df):
    from tickforge.plans.inspect import plan_text
    return plan_text(df, "simple")


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_equity_one_pass_single_scan_no_join(spark, static_plans):
    from tickforge.plans.inspect import plan_summary
    s = plan_summary(equity.equity_performance(tb.bars(spark, SF001)))
    assert s["scans"] == 1
    assert s["broadcast_joins"] == s["sort_merge_joins"] == s["nested_loop_joins"] == 0
    # bars aggregate, (symbol, month) window, symbol-level lag + final aggregate
    assert s["hash_exchanges"] == 3
    assert s["python_udfs"] == 0


def test_no_python_udf_or_cross_join_in_any_query(spark, static_plans):
    import __spark_entry__ as E
    from tickforge.plans import registry
    from tickforge.plans.inspect import plan_summary
    for name, fn in E.queries().items():
        if name in registry.RUNS_JOBS:
            continue  # writes tables or runs streams when called; tests/test_states.py looks at the plans of its parts
        if name.startswith("op") or name == "pipeline":
            continue  # run jobs when called, and may use Python; their own tests cover them
        s = plan_summary(fn(spark, SF001))
        assert s["python_udfs"] == 0 and s["nested_loop_joins"] == 0, name


def test_dashboard_one_scan_one_final_sort(spark, static_plans):
    p = plan(macro.macro_dashboard(tb.series(spark, SF001), as_of="2001-11-04"))
    assert len(re.findall("FileScan parquet", p)) == 1
    assert "Join" not in p
    assert len(re.findall("rangepartitioning", p)) == 1  # only the final ORDER BY


def test_head_per_key_partial_limit(spark, static_plans):
    p = plan(profile.head_per_key(tb.series(spark, SF001), "idx_type", "ref_date", 5))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_trend_filter_reaches_scan(spark, static_plans):
    path = os.path.join(tempfile.mkdtemp(prefix="series-"), "s")
    tb.series(spark, SF001).write.parquet(path)
    from tickforge.plans.inspect import pushed_filters, read_schemas
    df = macro.trend_6m(spark.read.parquet(path), as_of="2001-11-04")
    assert "GreaterThanOrEqual(ref_date,2001-05-04T00:00)" in pushed_filters(df)[0]
    assert read_schemas(df) == ["struct<idx_type:string,ref_date:timestamp_ntz,idx_value:double>"]


def test_segmented_equals_plain(spark):
    bars = tb.bars(spark, SF001)
    a = equity.daily_returns(bars, method="segmented").select("symbol", "trade_date", "prev_close")
    b = equity.daily_returns(bars, method="plain").select("symbol", "trade_date", "prev_close")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_trend_equals_join(spark):
    s = tb.series(spark, SF001)
    a = {r.idx_type: r.trend_6m for r in macro.macro_dashboard(s, as_of="2001-11-04").select("idx_type", "trend_6m").distinct().collect()}
    b = {r.idx_type: r.trend_6m for r in macro.trend_6m(s, as_of="2001-11-04").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-18)


def test_equity_reads_only_needed_columns(spark, static_plans):
    from tickforge.plans.fixtures import bronze_like
    from tickforge.operators import clean, silver
    path = os.path.join(tempfile.mkdtemp(prefix="silver-"), "eq")
    bronze = clean.stamp_ingestion(clean.rename_spaced(bronze_like(tb.bars(spark, SF001))))
    silver.silver_equity(bronze).write.parquet(path)
    p = plan(equity.equity_performance(spark.read.parquet(path)))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    schema = scan[scan.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    assert sorted(f.split(":")[0] for f in schema.split(",")) == [
        "close_price", "symbol", "trade_date", "volume"]
    from tickforge.plans.inspect import plan_summary
    s = plan_summary(equity.equity_performance(spark.read.parquet(path)))
    assert s["hash_exchanges"] == 2 and s["scans"] == 1


def test_series_map_broadcast_is_size_checked(spark, static_plans):
    from tickforge.sources import series as sr
    rows = spark.createDataFrame([(1178, "01/01/2024", "1")], "code int, data string, valor string")
    small = plan(sr.label_series(rows, sr.series_map(spark, '{"selic": 1178}')))
    assert "BroadcastHashJoin" in small
    # Above the bound no hint is given (Spark's own size threshold still applies).
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(sr.label_series(rows, sr.series_map(spark, '{"selic": 1178, "ipca": 433}'), max_broadcast=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in big


def test_dashboard_reads_only_needed_columns(spark, static_plans):
    from tickforge.operators import silver
    from tickforge.plans.inspect import plan_summary, read_schemas
    path = os.path.join(tempfile.mkdtemp(prefix="silver-macro-"), "m")
    s = tb.series(spark, SF001)
    bronze = s.select(F.col("ref_date").cast("timestamp").alias("data"), F.col("idx_value").alias("valor"),
                      F.col("idx_type").alias("serie"), F.current_timestamp().alias("ingestion_timestamp"))
    silver.silver_macro(bronze).write.parquet(path)
    dash = macro.macro_dashboard(spark.read.parquet(path), as_of="2001-11-04")
    assert read_schemas(dash) == ["struct<ref_date:timestamp,idx_value:double,idx_type:string>"]
    assert plan_summary(dash)["hash_exchanges"] == 2  # monthly aggregate, indicator window


def test_head_is_top_k_not_full_sort(spark, static_plans):
    p = plan(profile.head(tb.bars(spark, SF001), ["trade_date", "symbol"], 5))
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_partition_by_key_rebalances_and_sorts(spark):
    """Layout: a (key, month) lies in one partition (when small), sorted by key and date in each."""
    from pyspark.sql import functions as F
    from tickforge.operators.layout import partition_by_key
    out = partition_by_key(tb.bars(spark, SF001), "symbol", "trade_date")
    p = plan(out)
    assert "REBALANCE_PARTITIONS_BY_COL" in p
    rows = partition_by_key(tb.bars(spark, SF001), "symbol", "trade_date", num_partitions=5).select(
        F.spark_partition_id().alias("p"), "symbol", "trade_date").collect()
    where, last = {}, {}
    for r in rows:
        where.setdefault((r.symbol, r.trade_date.strftime("%Y-%m")), set()).add(r.p)
        assert last.get(r.p, (r.symbol, r.trade_date)) <= (r.symbol, r.trade_date)
        last[r.p] = (r.symbol, r.trade_date)
    assert all(len(v) == 1 for v in where.values()) and len(last) > 1


def test_month_partitions_are_pruned(spark):
    """A trailing trend on silver written by month reads only its months."""
    import tempfile
    from pyspark.sql import functions as F
    path = os.path.join(tempfile.mkdtemp(prefix="silver-"), "s")
    s = tb.series(spark, SF001).withColumn("ref_month", F.date_format("ref_date", "yyyy-MM"))
    s.write.partitionBy("ref_month").parquet(path)
    back = spark.read.parquet(path).filter("ref_month >= '2001-05'")
    got = macro.trend_6m(back.drop("ref_month"), as_of="2001-11-04")
    p = plan(got)
    assert "ref_month" in re.search(r"PartitionFilters: \[([^\]]*)\]", p)[1]
    assert {(r.idx_type, round(r.trend_6m, 12)) for r in got.collect()} == {
        (r.idx_type, round(r.trend_6m, 12)) for r in macro.trend_6m(tb.series(spark, SF001), as_of="2001-11-04").collect()}
