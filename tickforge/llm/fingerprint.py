"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is the weighted set of its words, a word's weight being its count. For each of ``samples`` independent samples every
word draws, from hashes of the word and the sample's number alone, two Gamma(2, 1) variables r and c (the
negative logarithm of a product of two uniform numbers) and a uniform b. With weight w

    t = floor(ln w / r + b),    ln a = ln c - r * (t - b + 1),

and the sample is (word, t) of the word with the smallest a. Two texts agree in a sample with a probability equal to
their generalised Jaccard similarity, the sum over words of the smaller count by the sum of the larger one. The share
of equal samples so estimates it with a standard deviation of at most 0.5 / sqrt(samples).

Words are counted by one hash aggregate and samples are minima of one long each (the rounded ln a above 32 bits that
name the sample), so both run in generated code and combine before any exchange. What a word draws with some
weight is the same in all texts, so the draws of the most frequent words and weights are looked up in a table of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import packed, stored, unpacked
from tickforge.llm.ranks import ranked

#: Multiple of 16.
SAMPLES = 32
#: White space between words.
BLANK = r"[\x20\x09-\x0D]"

_LOW = 0xFFFFFFFF


def _uniform_pair(h: Column) -> Column:
    """The product of two uniform numbers in (0, 1): the halves of a 64-bit hash."""
    low = h.bitwiseAND(F.lit(_LOW)).cast("double") + 0.5
    high = F.shiftrightunsigned(h, 32).cast("double") + 0.5
    return low * high * F.lit(2.0 ** -64)


def _sample(word: Column, log_weight: Column, seed: Column) -> Column:
    """A sample of a word as one long: ln a, rounded to 2**-23, above the 32 bits of (word, t).

    ``seed`` is three times the number of the sample: each takes three hashes.
    """
    h1 = F.xxhash64(word, seed)
    h2 = F.xxhash64(word, seed + 1)
    h3 = F.xxhash64(word, seed + 2)
    r = -F.ln(_uniform_pair(h1))
    log_c = F.ln(-F.ln(_uniform_pair(h2)))
    b = F.shiftrightunsigned(h3, 11).cast("double") * F.lit(2.0 ** -53)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t.cast("double") - b + 1.0)
    # ln a lies between -100 and 5, whatever the hashes.
    place = F.floor((log_a + 128.0) * F.lit(float(2 ** 23)))
    name = h3.bitwiseXOR(t.bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(2654435761)).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(place, 32).bitwiseOR(name)


def _counted(texts: DataFrame, by: list[str], text: str) -> DataFrame:
    """``by``, the hash of a word and its count; a null hash where pieces are empty or there is no word."""
    words = texts.select(*by, F.explode_outer(F.split(F.coalesce(F.col(text), F.lit("")), BLANK)).alias("__w"))
    hashed = F.when(F.col("__w") != "", F.xxhash64("__w"))
    return words.select(*by, hashed.alias("__h")).groupBy(*by, "__h").agg(F.count("*").alias("__n"))


def _weight() -> Column:
    return F.ln(F.col("__n").cast("double"))


#: Samples of one row of the sampling stage.
_STEP = 16


def common_samples(texts: DataFrame, samples: int = SAMPLES, text: str = "text", rows: int = 2000, words: int = 16384) -> DataFrame:
    """``ch, cn, known``: all samples of the most frequent pairs of a word (its hash) and its count in a text.

    A sample depends on the word, its count and the sample's number alone, so frequent words need not draw theirs anew in
    every text. The pairs are the ``words`` most frequent ones in about ``rows`` different texts, chosen by hash: they decide what
    is drawn anew, never what is drawn. The table holds at most ``words * (samples + 2)`` longs, so it may be broadcast.
    """
    named = texts.select(F.xxhash64(text, F.lit(23)).alias("t"), F.col(text).alias("text"))
    share = max(1, named.count() // rows)
    some = named.filter(F.pmod("t", F.lit(share)) == 0).dropDuplicates(["t"])
    often = (_counted(some, ["t"], "text").filter("__h is not null").groupBy("__h", "__n").agg(F.count("*").alias("f"))
             .orderBy(F.desc("f"), "__h", "__n").limit(words).select("__h", "__n"))
    drawn = often.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    drawn = drawn.select("__h", "__n", "j", _sample(F.col("__h"), _weight(), F.col("j") * 3).alias("v"))
    known = F.transform(F.array_sort(F.collect_list(F.struct("j", "v"))), lambda x: x["v"])
    return drawn.groupBy(F.col("__h").alias("ch"), F.col("__n").alias("cn")).agg(known.alias("known"))


def signatures(texts: DataFrame, by: list[str], text: str = "text", samples: int = SAMPLES, common: DataFrame | None = None) -> DataFrame:
    """``by`` and ``signature`` (array of ``samples`` ints, empty for a text without words) of every text.

    The columns ``by`` name one text each. Where the rows are already partitioned by some of them, nothing is shuffled.
    ``samples`` is a multiple of 16; ``common`` (:func:`common_samples`) saves drawing the samples of frequent words again.
    """
    if samples % _STEP:
        raise ValueError(f"samples must be a multiple of {_STEP}")
    counted = _counted(texts, by, text)
    if common is None:
        counted = counted.withColumn("known", F.lit(None).cast("array<long>"))
    else:
        counted = counted.join(F.broadcast(common), (F.col("__h") == F.col("ch")) & (F.col("__n") == F.col("cn")), "left")
    each = counted.select(*by, "__h", _weight().alias("__l"), "known",
                          F.explode(F.array(*[F.lit(k) for k in range(0, samples, _STEP)])).alias("__j"))
    drawn = [F.coalesce(F.get("known", F.col("__j") + i), _sample(F.col("__h"), F.col("__l"), F.col("__j") * 3 + 3 * i))
             for i in range(_STEP)]
    least = each.groupBy(*by, "__j").agg(*[F.min(F.when(F.col("__h").isNotNull(), d)).alias(f"__m{i}") for i, d in enumerate(drawn)])
    # The low half of a long as a signed int.
    codes = F.array(*[F.shiftright(F.shiftleft(F.col(f"__m{i}"), 32), 32).cast("int") for i in range(_STEP)])
    parts = least.select(*by, F.struct("__j", F.when(F.col("__m0").isNotNull(), codes).alias("c")).alias("__c"))
    ordered = F.transform(F.array_sort(F.collect_list("__c")), lambda x: F.coalesce(x["c"], F.expr("cast(array() as array<int>)")))
    return parts.groupBy(*by).agg(F.flatten(ordered).alias("signature"))


def likeness(a: str | Column, b: str | Column) -> Column:
    """Share of equal samples of two signatures of the same number of samples; 1 for two texts without words, 0 for one."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: F.coalesce(e, F.lit(False))))
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, 1.0).otherwise(same.cast("double") / F.greatest(most, F.lit(1)).cast("double"))


def printed(signature: str) -> Column:
    """A signature as text: eight hexadecimal digits a sample."""
    return F.array_join(F.transform(F.col(signature), lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(_LOW)))), 8, "0")), "")


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", samples: int = SAMPLES) -> DataFrame:
    """All columns and ``out``, the printed fingerprint of ``text``.

    Null and empty texts and texts of white space have no words: their fingerprint is empty. Very long texts are sampled over all
    their words. Equal texts have equal fingerprints, and are sampled once. Rows may repeat; an empty table gives an
    empty result; ``out`` replaces a column of that name.
    """
    names = list(docs.columns)
    base = packed(docs, a=lambda c: F.xxhash64(F.coalesce(c(text), F.lit(""))), b=lambda c: F.length(F.coalesce(c(text), F.lit(""))),
                  text=lambda c: F.coalesce(c(text), F.lit("")))
    one = base.groupBy("a", "b").agg(F.first("text").alias("text"))
    common = common_samples(base.select("text"), samples)
    signed = signatures(one, ["a", "b"], samples=samples, common=common).select(F.col("a").alias("sa"), F.col("b").alias("sb"),
                                                                 printed("signature").alias("__fp"))
    both = base.join(signed, (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb")))
    whole = unpacked(both, [f"k{i}" for i in range(len(names))], "__fp")
    return whole.select(*[F.col(f"k{i}").alias(n) for i, n in enumerate(names) if n != out], F.col("__fp").alias(out))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Every document beside an edited copy and beside its successor.

    The edited copy has the last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of the next
    document by ascending ``key`` (null first; after the last comes the first). One row a document: ``key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.

    Null texts count as empty. Documents with equal keys follow one another by a hash of their texts; rows equal in key and
    text are sampled once and follow one another. A document alone follows itself. An empty table gives an empty
    result; other columns are not read.

    Texts move once to be brought together by key, and the beginnings that their predecessors need move once more; the order
    is found on keys, hashes and lengths alone.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Two hashes name a row: one of key and text, one of the key.
    rows = rows.select("key", "text", F.xxhash64("key", "text").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    short = (rows.groupBy("a", "b").agg(F.min("key").alias("key"), F.min(F.length("text")).cast("long").alias("n"),
                                        F.count("*").alias("copies")).withColumn("one", F.lit("")))
    order = ranked(short, "one", ["key", "a"], "finger-order")
    after = order.select(F.col("pos").alias("npos"), F.col("a").alias("na"), F.col("b").alias("nb"))
    links = stored(order.join(after, F.pmod(F.col("pos") + 1, F.col("total")) == F.col("npos"))
                   .select(F.col("a").alias("pa"), F.col("b").alias("pb"), "key", "n", "copies", "na", "nb"), "finger-links")
    # Both uses of this aggregate read the same exchange.
    texts = rows.groupBy("a", "b").agg(F.first("text").alias("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    begins = (texts.join(links.hint("merge"), (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb")))
              .select("pa", "pb", "key", "n", "copies", "na", "nb", F.expr("substring(text, 1, cast(n div 2 as int))").alias("begin")))
    pairs = texts.join(begins.hint("merge"), (F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb"))).withColumn(
        "half", half).drop("pa", "pb")
    stay = F.col("text").substr(F.lit(1), (F.col("n") - F.col("half")).cast("int"))
    edited = F.concat(stay, F.col("begin"))
    # Between copies of one row the next document is the row itself.
    again = F.when(F.col("copies") > 1, F.concat(stay, F.col("text").substr(F.lit(1), F.col("half"))))
    kinds = F.array(F.struct(F.lit(1).alias("kind"), edited.alias("text")), F.struct(F.lit(2).alias("kind"), again.alias("text")))
    each = pairs.select("a", "b", F.explode(kinds).alias("k")).select("a", "b", "k.kind", "k.text").filter("text is not null")
    common = stored(common_samples(rows.select("text"), samples), "finger-common")
    # One after the other: a task holds the word counts of the texts, then of the edited ones.
    own = signatures(texts, ["a", "b"], samples=samples, common=common).select(
        F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("signature").alias("own"))
    signed = (signatures(each, ["a", "b", "kind"], samples=samples, common=common).groupBy("a", "b")
              .agg(F.map_from_entries(F.collect_list(F.struct("kind", "signature"))).alias("s"))
              .select(F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("s")[1].alias("edit"), F.col("s")[2].alias("again")))
    signed = signed.join(own.hint("merge"), (F.col("oa") == F.col("sa")) & (F.col("ob") == F.col("sb"))).drop("oa", "ob")
    facts = pairs.select("a", "b", "key", "n", "copies", "na", "nb", F.sha2(edited, 256).alias("edit_sha"), F.sha2(again, 256).alias("again_sha"))
    known = stored(facts.join(signed.hint("merge"), (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb"))).drop("sa", "sb"), "finger-signed")
    after = known.select(F.col("a").alias("xa"), F.col("b").alias("xb"), F.col("own").alias("next"))
    beside = known.join(after, (F.col("na") == F.col("xa")) & (F.col("nb") == F.col("xb")))
    # The last of equal rows is followed by another document, the others by the row itself.
    beside = beside.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    last = F.col("copy") == F.col("copies")
    shown = beside.select(
        F.col("key"), F.col("n"), F.when(last, F.col("edit_sha")).otherwise(F.col("again_sha")).alias("sha"), "own",
        F.when(last, F.col("edit")).otherwise(F.col("again")).alias("edit"),
        F.when(last, F.col("next")).otherwise(F.col("own")).alias("next"))
    return shown.select(F.col("key").alias(key), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                        printed("own").alias("fingerprint"), printed("edit").alias("edited_fingerprint"),
                        likeness("own", "edit").alias("near_edited"), likeness("own", "next").alias("near_next"))
