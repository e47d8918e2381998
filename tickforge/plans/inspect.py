"""Plan inspection from ``DataFrame.explain`` output: count the operators that
decide cost at scale (scans, exchanges, join kinds, windows)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_PATTERNS = {
    "scans": r"Scan parquet|FileScan parquet",
    "hash_exchanges": r"Exchange hashpartitioning",
    "range_exchanges": r"Exchange rangepartitioning",
    "single_partition_exchanges": r"Exchange SinglePartition",
    "broadcast_exchanges": r"BroadcastExchange",
    "broadcast_joins": r"BroadcastHashJoin",
    "sort_merge_joins": r"SortMergeJoin",
    "nested_loop_joins": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow \[",
    "window_group_limits": r"WindowGroupLimit",
    "python_udfs": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints, with scan details in full."""
    conf, key = df.sparkSession.conf, "spark.sql.maxMetadataStringLength"
    before = conf.get(key)
    conf.set(key, "10000")
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            df.explain(mode)
    finally:
        conf.set(key, before)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Operator counts of the physical plan (``explain("simple")``). With AQE
    on this is the initial plan; runtime may still pick broadcast joins."""
    text = plan_text(df, "simple")
    return {k: len(re.findall(p, text)) for k, p in _PATTERNS.items()}


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` lists of every parquet scan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "simple"))


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every parquet scan (pruned columns)."""
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan_text(df, "simple"))
