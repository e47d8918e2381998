"""Profiling: coverage, rows per key, describe, null counts, distinct keys,
column info, first rows (overall and per key). One job per table, never a
driver loop over keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.quantiles import exact_quantiles
from tickforge.session import written

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)


def coverage(df: DataFrame, key: str = "serie", date: str = "data") -> DataFrame:
    """Rows, distinct keys, first and last date (one two-phase aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(key).alias("n_keys"),
                  F.min(date).alias("first_date"),
                  F.max(date).alias("last_date"))


def rows_per_key(df: DataFrame, key: str = "ticker") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


# The quantiles reported by describe.
DESCRIBE_PROBS = [0.25, 0.5, 0.75]


def describe(df: DataFrame, columns: list[str] | None = None, by: str | None = None,
             final_rows: int = 100_000) -> DataFrame:
    """Per column (and per ``by`` key): count, mean, std (sample), min,
    q25, q50, q75 (exact, linear interpolation), max. NaN is treated as
    missing. Long format: one row per column (and key). ``final_rows`` is the largest
    group that is ranked in one task."""
    columns = columns or numeric_columns(df, exclude=[by] if by else [])
    ids = [by] if by else []
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ids, columns, "column_name", "value")
    long = long.withColumn("value", F.nanvl(F.col("value"), F.lit(None).cast("double")))
    keys = ids + ["column_name"]
    # NULL values stay in the moments' aggregate, so a column (or key) without
    # any value is reported with count 0; the quantiles skip them. Written: the quantiles
    # are planned by its counts, and the input is read once for it.
    moments = written(long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")), "describe")
    q = exact_quantiles(long, "value", DESCRIBE_PROBS, group=keys, final_rows=final_rows,
                        sizes=moments.select(*keys, F.col("count").alias("n")))
    qw = q.groupBy(*[F.col(k).alias(f"__q_{k}") for k in keys]).agg(*[
        F.max(F.when(F.col("p") == F.lit(p), F.col("quantile"))).alias(name)
        for p, name in zip(DESCRIBE_PROBS, ["q25", "q50", "q75"])])
    same = [F.col(k).eqNullSafe(F.col(f"__q_{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    out = moments.join(qw, cond, "left")
    return out.select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls) per column; NaN counts as missing for floating columns."""
    columns = columns or df.columns
    aggs = []
    for c in columns:
        dt = df.schema[c].dataType
        miss = F.col(c).isNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(F.col(c))
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("nulls")) for c in columns])
    return wide.select(F.inline(rows))


def distinct_keys(df: DataFrame, key: str = "serie") -> DataFrame:
    return df.select(key).distinct()


def column_info(df: DataFrame) -> DataFrame:
    """(position, column_name, type, non_null) — the schema plus one aggregate."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.col(f"`{f.name}`").alias("non_null"))
                     for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(rows))


def rows_of(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by ``order`` (Spark plans a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def head_per_key(df: DataFrame, key: str, order: str, n: int = 5) -> DataFrame:
    """First ``n`` rows per key. The ``row_number() <= n`` filter lets Spark
    insert a partial group limit before the shuffle, so at most ``n`` rows
    per key and input partition are exchanged, however large the key."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def sorted_rows(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order)


def profile_table(df: DataFrame, key: str, date: str) -> DataFrame:
    """The exploration profile of a table in one aggregate job: one row per
    column (position, type, non_null, nulls), each carrying the table-level
    coverage (rows, distinct keys, first / last date)."""
    aggs = [F.count(F.lit(1)).alias("__rows"), F.count_distinct(key).alias("__keys"),
            F.min(date).alias("__first"), F.max(date).alias("__last")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(~miss).alias(f"__nn{i}"))
        aggs.append(F.count_if(miss).alias(f"__nu{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.col(f"__nn{i}").alias("non_null"), F.col(f"__nu{i}").alias("nulls"))
                     for i, f in enumerate(df.schema.fields)])
    return wide.select(F.inline(rows), F.col("__rows").alias("rows"), F.col("__keys").alias("n_keys"),
                       F.col("__first").alias("first_date"), F.col("__last").alias("last_date"))
