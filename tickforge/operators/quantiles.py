"""Exact quantiles (linear interpolation, as ``quantile_cont`` / pandas)
without gathering an unbounded group into one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not hold for a hot group at scale. Here:

1. per group: n (one two-phase aggregate, written: it has
   one row per group); target ranks ``floor/ceil(p * (n - 1))``;
2. groups with at most ``final_rows`` values are ranked by a window over
   the group (bounded by ``final_rows``);
3. in larger groups each target rank is found digit by digit. A double is
   turned into a 64-bit integer of the same order (:func:`ordered_bits`),
   which is read as four digits of 16 bits. A round counts the values of
   each (group, prefix) by their next digit (an aggregate, map-side
   combined, at most 65,536 rows a prefix) and keeps the digit that holds the
   rank. After four rounds the pattern is complete, whatever the values are and
   however they are spread. The rows are read once more after the first round:
   those that share a first digit with a target rank are written, and the later
   rounds read only them.

Small and large groups are handled in the same call (a hot group does not
push the others through the rounds). Every step is a DataFrame job; the
driver reads one row of counts. Group and rank tables have ``groups x
ranks`` rows; they are broadcast only when that is at most ``broadcast_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.session import written


def _interpolate(got: DataFrame, g: list[str]) -> DataFrame:
    return got.select(*g, "p", (F.col("__v0") + F.col("__frac") * (F.col("__v1") - F.col("__v0")))
                      .alias("quantile"))


def _rank_in_group(vals: DataFrame, g: list[str], probs: list[float]) -> DataFrame:
    """Groups known to be small: rank inside the group and keep the rows at a
    target rank (no join against a rank table)."""
    wr = Window.partitionBy(*g).orderBy("__v")
    wn = Window.partitionBy(*g)
    ranked = (vals.withColumn("__r", F.row_number().over(wr) - 1)
              .withColumn("__n", F.count(F.lit(1)).over(wn)))
    ppos = F.col("__p") * (F.col("__n") - 1)
    hits = (ranked.withColumn("__p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumn("__k0", F.floor(ppos).cast("long"))
            .withColumn("__k1", F.ceil(ppos).cast("long"))
            .filter((F.col("__r") == F.col("__k0")) | (F.col("__r") == F.col("__k1"))))
    got = hits.groupBy(*g, F.col("__p").alias("p")).agg(
        F.max(F.when(F.col("__r") == F.col("__k0"), F.col("__v"))).alias("__v0"),
        F.max(F.when(F.col("__r") == F.col("__k1"), F.col("__v"))).alias("__v1"),
        F.max(ppos - F.floor(ppos)).alias("__frac"))
    return _interpolate(got, g)


#: Digits of a pattern: four of 16 bits.
_DIGIT, _ROUNDS = 16, 4


def ordered_bits(v: Column) -> Column:
    """A double (not NaN) as a long of the same order: exponent and fraction as in its binary form, negated below zero.

    Every step is exact: powers of two, quotients by them, and a fraction of 52 bits. Both zeros are 0.
    """
    a = F.abs(v)
    near = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(a)).cast("double")))
    # The logarithm is rounded, so the exponent may be off by one.
    up = F.when(F.pow(F.lit(2.0), near + 1) <= a, 1.0).otherwise(0.0)
    down = F.when(F.pow(F.lit(2.0), near) > a, 1.0).otherwise(0.0)
    e = F.greatest(F.lit(-1022.0), near + up - down)
    one = F.lit(2.0 ** 52)
    normal = (e + 1023).cast("long") * F.lit(2 ** 52) + ((F.try_divide(a, F.pow(F.lit(2.0), e)) - 1.0) * one).cast("long")
    tiny = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    bits = (F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(2047 * 2 ** 52))
            .when(a < F.lit(2.0 ** -1022), tiny).otherwise(normal))
    return F.when(v < 0, -bits).otherwise(bits)


def _select(vals: DataFrame, stats: DataFrame, g: list[str], probs: list[float], small) -> DataFrame:
    """Large groups: the digits of each target rank's value, one round a digit."""
    pos = F.col("p") * (F.col("__n") - 1)
    targets = (stats.select(*g, "__n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
               .withColumn("__k0", F.floor(pos).cast("long"))
               .withColumn("__k1", F.ceil(pos).cast("long"))
               .withColumn("__frac", pos - F.floor(pos)))
    # ``__prefix`` are the digits known so far, ``__below`` the values under them, ``__rank`` the rank asked for.
    state = (targets.select(*g, F.explode(F.array_distinct(F.array("__k0", "__k1"))).alias("__rank")).distinct()
             .withColumn("__prefix", F.lit(0).cast("long")).withColumn("__below", F.lit(0).cast("long")))
    rows = vals.withColumn("__bits", ordered_bits(F.col("__v")))
    for k in range(_ROUNDS):
        shift = _DIGIT * (_ROUNDS - 1 - k)
        # The first digit carries the sign; the digits of a prefix are read as one number.
        prefix = F.shiftright("__bits", shift + _DIGIT) if k else F.lit(0).cast("long")
        here = rows.select(*g, prefix.alias("__prefix"), F.shiftright("__bits", shift).alias("__next"), "__v")
        if k:
            here = here.join(small(state.select(*g, "__prefix").distinct()), g + ["__prefix"], "left_semi")
        hist = here.groupBy(*g, "__prefix", "__next").agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__val"))
        w = Window.partitionBy(*g, "__prefix").orderBy("__next")
        hist = hist.withColumn("__start", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c"))
        met = hist.join(state.select(*g, "__prefix", "__rank", "__below"), g + ["__prefix"])
        inside = F.col("__rank") - F.col("__below") - F.col("__start")
        met = met.filter((inside >= 0) & (inside < F.col("__c")))
        state = written(met.select(*g, "__rank", F.col("__next").alias("__prefix"),
                                   (F.col("__below") + F.col("__start")).alias("__below"), "__val"), "quantile-state")
        if k == 0:
            first = state.select(*g, F.col("__prefix").alias("__first")).distinct()
            rows = rows.withColumn("__first", F.shiftright("__bits", shift)).join(small(first), g + ["__first"], "left_semi")
            rows = written(rows.select(*g, "__bits", "__v"), "quantile-rows")
    found = state.select(*g, "__rank", "__val")
    # One join: each target asks for its two ranks, then folds them back.
    asks = targets.select(*g, "p", "__frac",
                          F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("__k0").alias("__rank")),
                                            F.struct(F.lit(1).alias("side"), F.col("__k1").alias("__rank"))))
                          .alias("__ask")).select(*g, "p", "__frac", "__ask.side", "__ask.__rank")
    got = asks.join(found, g + ["__rank"], "left").groupBy(*g, "p", "__frac").agg(
        F.max(F.when(F.col("side") == 0, F.col("__val"))).alias("__v0"),
        F.max(F.when(F.col("side") == 1, F.col("__val"))).alias("__v1"))
    return _interpolate(got, g)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: list[str] | None = None,
                    final_rows: int = 100_000, broadcast_rows: int = 100_000,
                    sizes: DataFrame | None = None) -> DataFrame:
    """-> DataFrame(*group, p, quantile), for groups with at least one value.

    ``sizes`` (``group`` and ``n``, the number of values that are neither NULL nor NaN) saves counting the groups
    where the caller has done so.
    """
    # Group columns travel in structs: a NULL in a struct equals itself in joins.
    names = list(group or [])
    g = [f"__key{i}" for i in range(len(names))]
    keys = [F.struct(F.col(n).alias("k")).alias(k) for n, k in zip(names, g)]
    vals = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    drop_g = not g
    if drop_g:
        vals = vals.withColumn("__g0", F.lit(0))
        g = ["__g0"]

    if sizes is None:
        stats = written(vals.groupBy(*g).agg(F.count(F.lit(1)).alias("__n")), "quantile-groups")
    else:
        stats = sizes.select(*(keys or [F.lit(0).alias("__g0")]), F.col("n").alias("__n")).filter("__n > 0")
    big = F.col("__n") > final_rows
    agg = stats.agg(F.count(F.lit(1)).alias("groups"), F.count_if(big).alias("big"),
                    F.count_if(~big).alias("small")).first()
    bcast = (agg["groups"] or 0) * 2 * len(probs) <= broadcast_rows

    def small(frame):
        return F.broadcast(frame) if bcast else frame

    parts = []
    if agg["big"] == 0:
        parts.append(_rank_in_group(vals, g, probs))
    elif agg["small"] == 0:
        parts.append(_select(vals, stats, g, probs, small))
    else:
        small_keys, big_keys = stats.filter(~big).select(*g), stats.filter(big).select(*g)
        parts.append(_rank_in_group(vals.join(small(small_keys), g, "left_semi"), g, probs))
        parts.append(_select(vals.join(small(big_keys), g, "left_semi"), stats.filter(big), g, probs, small))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if drop_g:
        out = out.drop("__g0")
    for k, n in zip(g, names):
        out = out.withColumn(k, F.col(k)["k"]).withColumnRenamed(k, n)
    return out
