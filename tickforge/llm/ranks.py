"""Places of rows in a sorted order, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import stored


def ranked(rows: DataFrame, within: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (long, from 0 in the order of ``order``, nulls first) and ``total`` inside each
    value of ``within`` (not null).

    The rows are range-sorted once and written; a row's place is its place in its partition plus the rows of
    the same ``within`` in the partitions before. Only one short row a partition and value is put in
    order by a window, so a value that holds all rows is spread like any other, and so are rows that are equal in
    every column (their own order is of no account).
    """
    by = [F.col(within).asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("__tie").asc()]
    put = (rows.withColumn("__tie", F.monotonically_increasing_id())
           .repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie"))
    put = stored(put.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    one = put.groupBy(F.col(within).alias("__w"), part.alias("__p")).agg(
        F.count("*").alias("__n"), F.min("__at").alias("__first"))
    every = W.partitionBy("__w")
    before = F.coalesce(F.sum("__n").over(every.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    one = one.select("__w", "__p", "__first", before.alias("__before"), F.sum("__n").over(every).alias("total"))
    out = put.join(one, (F.col(within) == F.col("__w")) & (part == F.col("__p")))
    return out.withColumn("pos", F.col("__before") + F.col("__at") - F.col("__first")).select(*rows.columns, "pos", "total")
