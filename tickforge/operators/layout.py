"""Physical layout and table writes for the layer tables.

``partition_by_key`` partitions on (key, month) rather than the key
alone, so a key holding a third of the rows still spreads over many tasks;
rows are then sorted by date inside each partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickforge.schemas import TableSpec


def partition_by_key(df: DataFrame, key: str, date: str | None = None,
                     num_partitions: int | None = None, by_month: bool = True,
                     bucket: str = "month") -> DataFrame:
    """Bring the rows of a (key, date bucket) together and sort by key and date
    in each partition.

    ``bucket`` is a ``date_trunc`` unit (``day`` for intraday rows), so one hot
    key is spread over its buckets. Without ``num_partitions`` this is a
    rebalance: adaptive execution splits buckets that are too large and joins
    small ones, so files come out at the advisory size.
    """
    cols, out = [key], df
    if date and by_month:
        out, cols = df.withColumn("__bucket", F.date_trunc(bucket, F.col(date))), [key, "__bucket"]
    out = out.repartition(num_partitions, *cols) if num_partitions else out.hint("rebalance", *cols)
    out = out.sortWithinPartitions(key, date) if date else out
    return out.drop("__bucket")


def write_table(df: DataFrame, spec: TableSpec | None = None, path: str | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet", observation: Observation | None = None,
                bucket_by: tuple[int, list[str]] | None = None,
                database: str | None = None) -> Observation:
    """Write a layer table: to ``path`` (files) or to the catalog under the
    spec's name (in ``database``, by default the layer's) with its comment and properties. The row count is observed
    during the write itself (no extra counting job).

    ``bucket_by=(n, cols)`` (catalog writes only) stores the table bucketed
    and sorted by ``cols``, so later aggregates and joins on them read it
    without a shuffle (the persistent form of partitioning by ticker).
    """
    obs = observation or Observation("write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and path:
        raise ValueError("bucket_by needs a catalog table (spec), not a path")
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if path:
        writer.save(path)
    else:
        if spec is None:
            raise ValueError("need a path or a TableSpec")
        spark = df.sparkSession
        name = spec.name_in(database)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        writer.saveAsTable(name)
        props = ", ".join(f"'{k}'='{v}'" for k, v in spec.properties.items())
        comment = spec.description.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props}, 'comment'='{comment}')")
    return obs


def latest_per_key(df: DataFrame, keys: list[str], order: str | list[str] = "ingestion_timestamp") -> DataFrame:
    """Keep, per key, the row that is greatest by ``order`` ("latest ingestion
    wins"), e.g. to compact bronze after corrections were landed.

    A NULL in ``order`` counts as earlier than any value; rows equal in
    ``order`` are told apart by their other columns, so the result does not
    depend on the order of arrival. Groups are the copies of one key (a bar),
    so a hot symbol is spread over its dates; the ``= 1`` filter lets Spark
    drop the losers of each input partition before the shuffle.
    """
    first = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in first]
    w = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in first + rest])
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).select(
        *[F.col(f"`{c}`") for c in df.columns])
