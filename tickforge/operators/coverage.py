"""Coverage kept up to date: exact distinct keys from bitmaps that merge.

Every key has a number in a dictionary that only grows. A state holds, for a month and a range of numbers, the
rows, the first and last date and a bitmap of the numbers seen. Bitmaps merge by OR, so the distinct keys of any
months come from their states alone, and only months that changed are counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_numbers(known: DataFrame | None, rows: DataFrame, key: str) -> DataFrame:
    """``key, number``: the dictionary with the keys of ``rows`` that it lacked, numbered on from its last number.

    NULL is no key. The new keys are numbered inside 256 hash buckets, whose sizes are then added up, so one task never
    holds all of them; a number is fixed once given. (Write the result before using it: it is the next ``known``.)
    """
    keys = rows.select(F.col(key).alias("key")).filter("key is not null").distinct()
    first = F.lit(0).cast("long")
    if known is not None:
        keys = keys.join(known.select(F.col("key").alias("__old")), F.col("key") == F.col("__old"), "left_anti")
        first = F.lit((known.agg(F.max("number")).first()[0] or 0) if known is not None else 0).cast("long")
    keys = keys.withColumn("__b", F.pmod(F.xxhash64("key"), F.lit(256)))
    sizes = keys.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("__b").alias("__sb"), before.alias("__before"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy("key"))
    new = keys.withColumn("__r", place).join(F.broadcast(sizes), F.col("__b") == F.col("__sb"))
    new = new.select("key", (first + F.col("__before") + F.col("__r")).cast("long").alias("number"))
    return new if known is None else known.select("key", "number").unionByName(new)


def coverage_states(df: DataFrame, numbers: DataFrame, key: str, date: str) -> DataFrame:
    """One row per (``ref_month``, bucket of key numbers): rows, first and last date, bitmap of the keys.

    Rows without a key count as rows (in a bucket of their own). Map-side combined; no set of keys is shuffled.
    """
    coded = df.select(F.col(key).alias("__key"), F.col(date).alias("__date")).join(
        numbers, F.col("__key") == F.col("key"), "left")
    month = F.date_trunc("month", F.col("__date"))
    bucket = F.bitmap_bucket_number("number")
    return coded.groupBy(month.alias("ref_month"), bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("__date").alias("first_date"), F.max("__date").alias("last_date"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("keys"))


def coverage_of_states(states: DataFrame) -> DataFrame:
    """``rows, n_keys, first_date, last_date`` as :func:`tickforge.operators.profile.coverage`, from states alone."""
    merged = states.groupBy("bucket").agg(F.sum("n_rows").alias("n"), F.min("first_date").alias("lo"),
                                          F.max("last_date").alias("hi"), F.bitmap_or_agg("keys").alias("keys"))
    n_keys = F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("keys")))
    return merged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(n_keys, F.lit(0)).alias("n_keys"),
                      F.min("lo").alias("first_date"), F.max("hi").alias("last_date"))
