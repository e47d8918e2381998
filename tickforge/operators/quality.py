"""Row checks (warn / drop / fail), non-null key checks, per-key source status.

A check is a name and a SQL predicate. A row fails when the predicate is not
TRUE (NULL counts as a failure). Counting happens inside the job that uses
the rows (``DataFrame.observe``) or as one aggregate report; never a
separate ``count()`` per check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    name: str
    predicate: str

    def passed(self):
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# The silver equity checks.
SILVER_EQUITY_CHECKS = [
    Check("valid_close", "close_price IS NOT NULL"),
    Check("valid_date", "trade_date IS NOT NULL"),
]


def not_null_checks(schema: T.StructType, columns=None) -> list[Check]:
    """One check per non-nullable field (Spark does not enforce nullability
    on file reads, so the contract is checked on the data)."""
    fields = [f for f in schema.fields if not f.nullable and (columns is None or f.name in columns)]
    return [Check(f"{f.name}_not_null", f"`{f.name}` IS NOT NULL") for f in fields]


def check_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: (check, passed, failed). A single aggregate."""
    aggs = []
    for i, c in enumerate(checks):
        aggs.append(F.count_if(c.passed()).alias(f"p{i}"))
        aggs.append(F.count_if(~c.passed()).alias(f"f{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"p{i}").alias("passed"),
                              F.col(f"f{i}").alias("failed")) for i, c in enumerate(checks)])
    return wide.select(F.inline(rows))


def apply_checks(df: DataFrame, checks: list[Check], mode: str = "warn",
                 observation: Observation | None = None) -> DataFrame:
    """``warn``: keep every row, count failures into ``observation`` while the
    rows flow; ``drop``: keep rows passing all checks; ``fail``: raise on the
    first failing row."""
    if mode == "warn":
        obs = observation or Observation("checks")
        metrics = [F.count_if(~c.passed()).alias(c.name) for c in checks]
        return df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    if mode == "drop":
        cond = F.lit(True)
        for c in checks:
            cond = cond & c.passed()
        return df.filter(cond)
    if mode == "fail":
        # Inside a filter predicate, so column pruning cannot skip it.
        out = df
        for c in checks:
            out = out.filter(F.when(c.passed(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"check failed: {c.name}")).cast("boolean")))
        return out
    raise ValueError("mode must be 'warn', 'drop' or 'fail'")


#: Parts of a table written by :func:`write_split`.
GOOD, QUARANTINE = "good", "quarantine"


def with_failures(df: DataFrame, checks: list[Check], out: str = "failed_checks") -> DataFrame:
    """``df`` with the names of the checks that a row fails (in the order of ``checks``; empty: none)."""
    return df.withColumn(out, F.array_compact(F.array(*[F.when(~c.passed(), F.lit(c.name)) for c in checks])))


def write_split(df: DataFrame, checks: list[Check], path: str, out: str = "failed_checks") -> dict[str, int]:
    """Write the rows that pass all checks and those that fail to two parts of one folder, in one pass over ``df``.

    Failing rows keep all their columns and carry the names of the failed checks in ``out``. Returns
    the numbers of rows, of failing rows and of failures of each check, counted in the same pass.
    """
    flagged = with_failures(df, checks, out)
    bad = F.size(out) > 0
    seen = Observation()
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias(QUARANTINE),
                              *[F.count_if(F.array_contains(out, c.name)).alias(f"failed {c.name}") for c in checks])
    counted.withColumn("__part", F.when(bad, QUARANTINE).otherwise(GOOD)).write.partitionBy("__part").parquet(path)
    return dict(seen.get)


def read_split(df_schema: T.StructType, spark, path: str, part: str, out: str = "failed_checks") -> DataFrame:
    """One part of a folder of :func:`write_split` (also if no row went there); only its files are opened."""
    fields = [f for f in df_schema.fields if f.name != out] + [T.StructField(out, T.ArrayType(T.StringType()))]
    schema = T.StructType([*fields, T.StructField("__part", T.StringType())])
    return spark.read.schema(schema).parquet(path).filter(F.col("__part") == part).drop("__part")


# Status labels of the per-key source outcome.
STATUS_NO_DATA = "no_data"
STATUS_MALFORMED = "malformed"
STATUS_NO_HISTORY = "no_history"
STATUS_NONE_IN_PERIOD = "none_in_period"
STATUS_ALL_INVALID = "all_invalid"
STATUS_OK = "ok"


def _bar_counts(rows: DataFrame, key: str, date: str, value: str, lo=None, hi=None) -> DataFrame:
    """Per key (``__bk``): rows, rows in the period, rows in it with a valid value."""
    d = F.col(date).cast("timestamp")
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (d >= lo)
    if hi is not None:
        inside = inside & (d <= hi)
    return rows.groupBy(F.col(key).alias("__bk")).agg(
        F.count(F.lit(1)).alias("rows_total"), F.count_if(inside).alias("rows_in_period"),
        F.count_if(inside & F.col(value).isNotNull() & ~F.isnan(F.col(value))).alias("rows_valid"))


def _bar_status(otherwise):
    """The upper part of the ladder: what the bars say; ``otherwise`` where there are none."""
    return (F.when(F.col("rows_valid") > 0, STATUS_OK).when(F.col("rows_in_period") > 0, STATUS_ALL_INVALID)
            .when(F.col("rows_total") > 0, STATUS_NONE_IN_PERIOD).otherwise(otherwise))


def source_status(requested: DataFrame, rows: DataFrame, start, end, key: str = "symbol",
                  date: str = "trade_date", value: str = "close_price",
                  max_days: int | None = None, fmt: str = "d/M/yyyy") -> DataFrame:
    """Per requested key: (key, status, rows_total, rows_in_period, rows_valid): :func:`source_outcome` where
    only the bars are known.

    ``rows`` are the fetched bars (NULL value = unparseable). Per-key counts
    are one two-phase aggregate; the requested list (config-sized) is the
    left side of the join, so a key with no rows at all is reported too.
    """
    from tickforge.functions.dates import clamp_start, end_of_day_bound

    lo = clamp_start(start, end, max_days, fmt).cast("timestamp")
    counts = _bar_counts(rows, key, date, value, lo, end_of_day_bound(end, fmt))
    out = requested.join(counts, requested[key] == counts["__bk"], "left").drop("__bk")
    out = out.na.fill(0, subset=["rows_total", "rows_in_period", "rows_valid"])
    return out.withColumn("status", _bar_status(F.lit(STATUS_NO_DATA)))


def source_outcome(requested: DataFrame, documents: DataFrame, bars: DataFrame, start=None, end=None,
                   key: str = "symbol", bar_key: str = "ticker", date: str = "Date", value: str = "Close",
                   fmt: str = "d/M/yyyy") -> DataFrame:
    """One status per requested key over the whole ladder: no document landed
    (or none with results), only malformed documents, no history, no bar in the
    period, no valid value, ok.

    ``documents`` is :func:`tickforge.sources.payload.payload_outcome`. Both
    sides are counted per key before they meet the requested list, so one
    short row a key is joined.
    """
    from tickforge.functions.dates import as_date, end_of_day_bound

    docs = documents.groupBy(F.col("ticker").alias("__dk")).agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("malformed", "no_results", "no_history")])
    rows = _bar_counts(bars, bar_key, date, value, None if start is None else as_date(start, fmt).cast("timestamp"),
                       None if end is None else end_of_day_bound(end, fmt))
    counts = ["documents", "malformed", "no_results", "no_history", "rows_total", "rows_in_period", "rows_valid"]
    out = (requested.select(key).distinct()
           .join(docs, F.col(key) == F.col("__dk"), "left").join(rows, F.col(key) == F.col("__bk"), "left")
           .na.fill(0, subset=counts))
    n = F.col
    status = _bar_status(
        F.when((n("documents") > 0) & (n("malformed") == n("documents")), STATUS_MALFORMED)
        .when(n("no_history") > 0, STATUS_NO_HISTORY)
        .when(n("documents") > n("malformed") + n("no_results"), STATUS_NONE_IN_PERIOD).otherwise(STATUS_NO_DATA))
    return out.select(key, *counts, status.alias("status"))
