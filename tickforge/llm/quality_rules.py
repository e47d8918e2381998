"""Quality rules with risk-controlled cutoffs.

Every rule rejects documents whose value (a ratio of counts of the text) lies above a
cutoff. The cutoffs are learned per stratum from labelled documents: a cutoff is
*certified* when, by the exact binomial tail, the share of good documents that it rejects
is below the allowed risk. With ``n`` good labelled documents of which ``k`` are rejected,
the hypothesis "the risk is above alpha" is refused if P(Binomial(n, alpha) <= k) is at
most its share of ``delta``. The shares divide ``delta`` by the number of rules and strata
(Bonferroni); inside a rule the cutoffs are tested in fixed order, from lenient to strict,
which needs no further division. ``alpha`` is divided by the number of rules, so all rules
together reject at most a share ``alpha`` of a stratum's good documents, in all strata at
once, with probability 1 - ``delta``.

Of the certified cutoffs a rule takes the one with the best balance of rejected labelled
junk and good documents; ties take the more lenient one. A stratum with too few labels has no
certified cutoff, and the rules reject nothing there.

All work is built-in column functions; texts are read once, and only counts are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import ROW, packed, stored, unpacked

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX_BITS = 22

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def _grid(low: float, high: float, steps: int) -> list[float]:
    """Cutoffs from strict to lenient, evenly spaced."""
    return [round(low + (high - low) * i / (steps - 1), 6) for i in range(steps)]


#: Rules: value, and the cutoffs to test (chosen without looking at data).
RULES: dict[str, tuple[str, list[float]]] = {
    "long_words": ("try_divide(word_chars, n_words)", _grid(5.0, 30.0, 51)),
    "short_words": ("-try_divide(word_chars, n_words)", _grid(-5.0, -1.0, 41)),
    "symbols": ("try_divide(n_symbols, n_words)", _grid(0.01, 1.0, 100)),
    "repeated_lines": ("try_divide(n_dup_lines, n_lines)", _grid(0.02, 1.0, 50)),
    "repeated_words": ("try_divide(n_repeat_words, n_words)", _grid(0.02, 0.5, 49)),
    "capitals": ("try_divide(n_capitals, word_chars)", _grid(0.05, 1.0, 39)),
}


def _repeat_words(words: str, windows: str) -> str:
    """SQL: words covered by three-word windows that occur twice or more.

    ``windows`` is the array of window hashes (64 bits; two windows of a text sharing one by
    chance are out of reach). Sorting needs hash and place together: they are packed into
    one number, the hash cut to 42 bits, as numbers sort fast. If the cut makes different
    windows look equal (the count of repeated ones then differs from that of the full
    hashes), or the text is too long for the place's bits, pairs are sorted instead.
    """
    low = (1 << INDEX_BITS) - 1

    def alike(sorted_array: str, key: str) -> str:
        k = lambda x: key.format(x)
        return (f"filter({sorted_array}, (x, i) -> coalesce({k('x')} = {k(f'get({sorted_array}, i - 1)')}, false)"
                f" or coalesce({k('x')} = {k(f'get({sorted_array}, i + 1)')}, false))")

    def covered(places: str) -> str:
        return (f"aggregate(transform({places}, (x, i) -> least(3, coalesce(get({places}, i + 1) - x, 3))),"
                " 0L, (a, x) -> a + x)")

    def let(value: str, name: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    packed_hits = let(f"sort_array(transform({windows}, (x, i) -> (x & {~low}L) | cast(i as bigint)))", "s",
                      alike("s", f"shiftright({{}}, {INDEX_BITS})"))
    packed_places = f"sort_array(transform(hits, x -> x & {low}L))"
    pair_hits = let(f"array_sort(transform({windows}, (x, i) -> struct(x as h, cast(i as bigint) as i)))", "s",
                    alike("s", "{}.h"))
    pair_places = f"sort_array(transform({pair_hits}, x -> x.i))"
    n_equal = let(f"sort_array({windows})", "s", f"size({alike('s', '{}')})")
    slow = let(pair_places, "p", covered("p"))
    fast = let(packed_hits, "hits", f"case when size(hits) = {n_equal} then {let(packed_places, 'p', covered('p'))}"
                                    f" else {slow} end")
    return (f"case when size({words}) < 3 or size(array_distinct({windows})) = size({windows}) then 0L"
            f" when size({words}) > {low} then {slow} else {fast} end")


def with_counts(df: DataFrame, text: Column) -> DataFrame:
    """Add the counts :data:`FEATURES` of a text column (null: no words) to ``df``."""
    df = df.withColumn("__t", F.coalesce(text, F.lit("")))
    df = df.withColumn("__w", F.expr(r"filter(split(__t, '[\\x20\\x09-\\x0D]+'), w -> w != '')"))
    df = df.withColumn("__h", F.expr(
        "case when size(__w) < 3 then cast(array() as array<bigint>) else"
        " transform(slice(__w, 1, size(__w) - 2), (w, i) -> xxhash64(w, get(__w, i + 1), get(__w, i + 2))) end"))
    t = F.col("__t")
    gone = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    df = df.withColumn("__l", F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0))
    return df.select(
        *[c for c in df.columns if c not in ("__t", "__w", "__h", "__l")],
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        gone(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words("__w", "__h")).alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        gone(CAPITALS).cast("long").alias("n_capitals"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series, shifted up by 8."""
    y = x + 8
    series = ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
              + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y))
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact to rounding; 1 where k >= n * p (never a proof of low risk).

    Below the mean the terms fall from k downwards, so they are summed from the largest;
    beyond ``50000`` terms the rest is bounded by its largest term, which errs upwards.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = (_log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1)
           + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    terms = F.aggregate(
        F.sequence(F.lit(0), F.least(k, F.lit(50_000)).cast("int")),
        F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, i: F.struct(
            (a["t"] * (kd - i) / (nd - kd + i + 1) * ((1 - p) / p)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"] + a["t"] * F.greatest(kd - 50_000, F.lit(0.0)))
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * terms))


def certified_cutoffs(labelled: DataFrame, alpha: float, delta: float, junk_weight: float = 0.2) -> DataFrame:
    """One row a stratum and rule: ``stratum, rule, cutoff, good, rejected_good, rejected_junk, p``.

    ``labelled``: ``stratum``, ``good`` (boolean) and :data:`FEATURES` of documents that pass
    the base rules. ``cutoff`` is null where none is certified or worth its price.
    """
    def level(name: str) -> Column:
        value, grid = RULES[name]
        # How many cutoffs of the rule would reject the document.
        return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: F.expr(value) > c))

    rows = labelled.select(
        "stratum", "good",
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), level(r).alias("level")) for r in RULES])).alias("x"))
    hist = rows.groupBy("stratum", "x.rule", "x.level").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("junk"))
    # Every cutoff, also those between occupied levels: level i rejects all above it.
    grids = F.create_map(*[x for r, (_, g) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, g)))])
    per_rule = hist.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"),
        F.collect_list(F.struct("level", "good", "junk")).alias("bins"))  # at most one a cutoff
    cuts = per_rule.select("stratum", "rule", "n_good", "bins", F.posexplode(grids[F.col("rule")]).alias("at", "cutoff"))
    reject = lambda f: F.aggregate(
        "bins", F.lit(0).cast("long"), lambda a, b: a + F.when(b["level"] > F.col("at"), b[f]).otherwise(0))
    cuts = cuts.select("stratum", "rule", "cutoff", F.col("n_good").alias("good"),
                       reject("good").alias("rejected_good"), reject("junk").alias("rejected_junk"))
    n_strata = labelled.agg(F.approx_count_distinct("stratum", 0.01)).first()[0] + 1  # null may be one more
    share = delta / (len(RULES) * n_strata * 1.1)  # room for the error of the count
    cuts = cuts.withColumn("p", binomial_tail(F.col("rejected_good"), F.col("good"), alpha / len(RULES)))
    worth = F.col("rejected_junk") * junk_weight - F.col("rejected_good")
    best = W.partitionBy("stratum", "rule").orderBy(
        F.when((F.col("p") <= share) & (worth > 0), worth).desc_nulls_last(), F.col("cutoff").desc())
    return (cuts.withColumn("ok", (F.col("p") <= share) & (worth > 0))
            .withColumn("rank", F.row_number().over(best)).filter("rank = 1")
            .withColumn("cutoff", F.when(F.col("ok"), F.col("cutoff"))).drop("rank", "ok"))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          stratum: str = "lang", label: str = "quality", keep: list[str] | None = None,
          alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and ``reasons`` (names of failed rules) to documents.

    ``labels`` has ``key`` and ``label`` (1 good, 0 junk; null or contradicting labels are left
    out). ``keep`` names the columns to carry, by default all. A null or empty text has no words
    and fails the base rules; a null stratum is a stratum of its own; a null key has no label;
    equal rows are judged alike; empty tables give an empty result, and without labels
    only the base rules reject. Columns of ``docs`` keep their names even where an added
    column is called the same.
    """
    names = docs.columns if keep is None else keep
    base = packed(docs, keep=keep, k=lambda c: c(key), stratum=lambda c: c(stratum).cast("string"),
                  t=lambda c: c(text))
    base = with_counts(base, F.col("t")).drop("t")
    base = stored(base.withColumn("base_failed", (F.col("n_words") < 50)
                                  | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "quality")
    known = (labels.select(F.col(key).alias("lk"), F.col(label).cast("int").alias("q")).filter("q in (0, 1)")
             .groupBy("lk").agg(F.min("q").alias("q"), F.max("q").alias("q2")).filter("q = q2"))
    labelled = (base.filter(~F.col("base_failed")).join(known, F.col("k") == F.col("lk"))
                .select("stratum", (F.col("q") == 1).alias("good"), *FEATURES))
    cuts = certified_cutoffs(stored(labelled, "quality-labelled"), alpha, delta)
    limits = cuts.groupBy(F.col("stratum").alias("s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])
    judged = base.join(limits, F.col("stratum").eqNullSafe(F.col("s")), "left")
    failed = [F.when(F.expr(v) > F.col(f"max_{r}"), F.lit(r)) for r, (v, _) in RULES.items()]
    judged = judged.withColumn("reasons", F.array_compact(F.array(*failed)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
    return unpacked(judged.select(ROW, *FEATURES, "base_failed", "kept", "reasons"), names,
                    *FEATURES, "base_failed", "kept", "reasons")
