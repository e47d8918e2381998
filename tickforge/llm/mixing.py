"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is put in a shuffled (hash) order. A copy of a
document finishes at the virtual time *cumulative words of its source, this
copy included, divided by the source's target*; a second or third round over
the same source goes on where the round before ended. All copies are then
served in the order of their finish times until the total budget is used up.
A source so gets its target at virtual time 1, whatever its number of rows.

The running sums are built in two levels, so no task holds a whole source:
a source is cut into buckets of about ``bucket_rows`` rows by hash, the sums of
the buckets are accumulated, then the rows inside each bucket. The global order
is cut the same way into bins of finish time; only the bin in which the budget
runs out is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import ROW, WORD, discard, packed, stored, unpacked, unsigned_fraction

MAX_REPEATS = 3


def source_targets(sizes: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of all sources: weights 1, 2, 3 in turn by code point, null last.

    ``sizes`` has one row a source: ``src``, ``source_size``. The targets share
    the total by weight; none is above ``repeats`` times its source, and the
    excess is reshared. A source is held at its limit exactly when its limit per
    weight is at most the final share per weight, so one pass over the sources in
    the order of limit per weight finds the fixed point. Sources without words
    get 0. One task sees one short row a source, never documents.
    """
    by_name = W.orderBy(F.col("src").asc_nulls_last())
    by_limit = W.orderBy("limit_per_weight", "source_rank")
    upto = by_limit.rowsBetween(W.unboundedPreceding, -1)
    total = W.partitionBy()
    s = (sizes.withColumn("source_rank", F.row_number().over(by_name))
         .withColumn("weight", ((F.col("source_rank") - 1) % 3 + 1).cast("double"))
         .withColumn("limit", F.col("source_size").cast("double") * repeats)
         .withColumn("limit_per_weight", F.col("limit") / F.col("weight")))
    # Share per weight if exactly the sources before this one are at their limit.
    s = (s.withColumn("held_before", F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
         .withColumn("weight_before", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
         .withColumn("share", (F.sum("source_size").over(total) - F.col("held_before"))
                     / (F.sum("weight").over(total) - F.col("weight_before")))
         # The first source whose limit is above that share ends the held ones.
         .withColumn("free", F.col("limit_per_weight") > F.col("share"))
         .withColumn("final_share", F.first(F.when(F.col("free"), F.col("share")), True).over(
             by_limit.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    target = F.when(F.col("limit_per_weight") > F.col("final_share"),
                    F.col("final_share") * F.col("weight")).otherwise(F.col("limit"))
    return s.select("src", "source_size", "source_rank", "weight", target.alias("target"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
        keep: list[str] | None = None, seed: int = 20240, repeats: int = MAX_REPEATS,
        bucket_rows: int = 5_000) -> DataFrame:
    """Add ``size, source_size, target, copies`` to every document.

    ``copies`` (0 to ``repeats``) says how often the mix takes the document and
    ``size`` counts its words; ``keep`` names the columns to carry (all of them
    by default). All rows are kept, so the caller can filter or
    repeat. The order is a keyed hash of key and text, so reruns agree; rows that
    are equal in all columns are interchangeable. A null source is a source of
    its own, a null or empty text has size 0, an empty table gives an empty
    result; other columns pass through whatever their names.
    """
    names = docs.columns if keep is None else keep
    base = packed(
        docs, keep=keep,
        src=lambda c: c(source),
        size=lambda c: F.coalesce(F.regexp_count(c(text), F.lit(WORD)), F.lit(0)).cast("long"),
        h=lambda c: F.xxhash64(c(key), c(text), F.lit(seed)),
        k=lambda c: c(key).cast("string"))
    base = stored(base, "mix-sizes")

    sizes = base.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sizes = stored(sizes, "mix-sources")
    targets = source_targets(sizes.select("src", "source_size")).withColumnRenamed("src", "t_src")
    targets = (sizes.join(targets.drop("source_size"), F.col("src").eqNullSafe(F.col("t_src")))
               .drop("t_src")
               .withColumn("n_buckets", F.ceil(F.col("rows") / bucket_rows))
               .withColumnRenamed("src", "t_src"))
    targets = stored(targets, "mix-targets")  # one row a source

    rows = (base.join(targets.select("t_src", "n_buckets"), F.col("src").eqNullSafe(F.col("t_src")))
            .drop("t_src")
            .withColumn("bucket", F.floor(unsigned_fraction(F.col("h")) * F.col("n_buckets"))))
    inside = W.partitionBy("src", "bucket").orderBy("h", "k", "size")
    rows = stored(rows.drop("n_buckets").withColumn(
        "cum_in", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))), "mix-cum")
    discard(base)
    ahead = W.partitionBy("o_src").orderBy("o_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (rows.groupBy(F.col("src").alias("o_src"), F.col("bucket").alias("o_bucket"))
               .agg(F.sum("size").alias("bucket_size"))
               .withColumn("offset", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
               .drop("bucket_size")
               .join(targets.select("t_src", "source_size", "source_rank", "target"),
                     F.col("o_src").eqNullSafe(F.col("t_src"))).drop("t_src"))
    rows = (rows.join(offsets, F.col("src").eqNullSafe(F.col("o_src"))
                      & (F.col("bucket") == F.col("o_bucket")))
            .withColumn("cum", F.col("offset") + F.col("cum_in")))

    def finish(e: int):
        """Virtual finish time of copy ``e``; null where there is nothing to serve."""
        return F.when(F.col("target") > 0,
                      (F.lit(float(e)) * F.col("source_size") + F.col("cum")) / F.col("target"))

    def place(e: int):
        return F.struct(finish(e).alias("finish"), F.col("source_rank").alias("rank"),
                        F.lit(e).alias("round"), F.col("cum").alias("cum"),
                        F.col("h").alias("h"), F.col("k").alias("k"))

    # Total words in each bin of finish time: how far does the budget reach?
    stats = sizes.agg(F.sum("source_size").alias("budget"), F.sum("rows").alias("rows")).first()
    budget, n = int(stats["budget"] or 0), int(stats["rows"] or 0)
    last = None
    if budget > 0:
        n_bins = max(16, -(-n // bucket_rows) * 4)
        slim = rows.select("size", "cum", "h", "k", "source_size", "source_rank", "target")
        items = (slim.select("size", F.explode(F.array(*[place(e) for e in range(repeats)])).alias("at"))
                 .filter(F.col("at.finish").isNotNull() & (F.col("size") > 0))
                 # Behind time 2 nothing can be reached: by then every source has either
                 # had all its rounds or its target twice.
                 .withColumn("bin", F.floor(F.least(F.col("at.finish"), F.lit(2.0)) * n_bins)))
        bins = items.groupBy("bin").agg(F.sum("size").alias("words"))
        upto = W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        cut = (bins.withColumn("cum", F.sum("words").over(upto))
               .filter(F.col("cum") > budget).orderBy("bin").limit(1).collect())
        if cut:
            room = budget - (cut[0]["cum"] - cut[0]["words"])
            served = (items.filter(F.col("bin") == cut[0]["bin"])
                      .withColumn("cum", F.sum("size").over(
                          W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)))
                      .filter(F.col("cum") <= room).agg(F.max("at").alias("last")).first())
            last = (served["last"], cut[0]["bin"] / n_bins)
    if budget == 0:
        copies = F.lit(0)
    elif last is None:  # every round of every source fits
        copies = F.when(F.col("target") > 0, F.lit(repeats)).otherwise(F.lit(0))
    else:
        at, edge = last
        def taken(e: int):
            if at is None:  # nothing of the last bin fits: all before it is served
                return F.coalesce(finish(e) < F.lit(edge), F.lit(False))
            end = F.struct(F.lit(at["finish"]).alias("finish"), F.lit(at["rank"]).alias("rank"),
                           F.lit(at["round"]).alias("round"), F.lit(at["cum"]).cast("long").alias("cum"),
                           F.lit(at["h"]).cast("long").alias("h"),
                           F.lit(at["k"]).cast("string").alias("k"))
            return finish(e).isNotNull() & (place(e) <= end)
        copies = sum((taken(e).cast("int") for e in range(1, repeats)), taken(0).cast("int"))
        copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0))
    out = rows.select(ROW, F.col("size"), F.col("source_size"), F.col("target"),
                      copies.alias("copies"))
    return unpacked(out, names, "size", "source_size", "target", "copies")


def repeated(mixed: DataFrame, names: list[str]) -> DataFrame:
    """One row for each copy that the mix takes."""
    return (mixed.filter(F.col("copies") > 0)
            .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*names))
