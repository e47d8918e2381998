import math
import random
import re

from pyspark.sql import functions as F

from tickforge.llm import quality_rules as qr
from tickforge.llm.common import packed

DOCS = "doc_id long, text string, lang string, n_words string"
LABELS = "doc_id long, quality int, toxic int"


def _counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(wins):
        if wins.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit))


def _texts(seed, n):
    rng = random.Random(seed)
    out = [None, "", " \n\t ", "a", "a b", "a b c", "a a a a", "x y z x y z", "é 😀 #\n\né 😀 #\n \n"]
    for _ in range(n):
        vocab = [f"w{i}" for i in range(rng.choice([2, 5, 40, 400]))] + ["é", "日本", "#%", "A|B"]
        out.append("".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t", "  ", "\x0b"])
                           for _ in range(rng.randint(1, 200))))
    return out


def test_counts(spark):
    texts = _texts(1, 150)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for r in qr.with_counts(df, F.col("t")).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == \
            _counts(texts[r["i"]]), texts[r["i"]]


def test_repeat_words_on_colliding_and_long_places(spark, monkeypatch):
    """With few bits for places, both ways out of packing are taken."""
    texts = _texts(2, 60)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    monkeypatch.setattr(qr, "INDEX_BITS", 6)
    got = {r["i"]: r["n_repeat_words"] for r in qr.with_counts(df, F.col("t")).collect()}
    assert got == {i: _counts(t)[4] for i, t in enumerate(texts)}


def test_binomial_tail(spark):
    cases = [(0, 100, 0.01), (3, 1000, 0.01), (40, 5000, 0.01), (900, 100_000, 0.01), (0, 1, 0.3), (9, 10, 0.95)]
    for k, n, p in cases:
        got = spark.range(1).select(qr.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                            + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        if k >= n * p:
            assert got == 1.0
        else:
            assert abs(got - want) < 1e-9 + 1e-6 * want
    big = spark.range(1).select(qr.binomial_tail(F.lit(9_990_000), F.lit(10**10), 0.001)).first()[0]
    assert 0 < big < 0.01


def _corpus(n, seed=4):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(3000)]
    docs, labels = [], []
    for i in range(n):
        junk = rng.random() < 0.15
        words = [rng.choice(vocab) for _ in range(60)]
        if junk:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words), rng.choice(["en", None]), "x"))
        labels.append((i, 0 if junk else 1, 0))
    return docs, labels


def test_cutoffs_reject_junk_and_hold_the_risk(spark):
    docs, labels = _corpus(4000)
    d, lb = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r["kept"] for r in qr.judge(d, lb, keep=["doc_id"]).collect()}
    good = {i for i, q, _ in labels if q}
    assert not any(got[i] for i in got if i not in good)
    assert sum(not got[i] for i in good) <= 0.02 * len(good)
    # Certified exactly where the tail bound allows.
    base = qr.with_counts(packed(d, k=lambda c: c("doc_id"), stratum=lambda c: c("lang"), t=lambda c: c("text")),
                          F.col("t"))
    lab = base.join(lb.withColumnRenamed("doc_id", "k2"), F.col("k") == F.col("k2")).withColumn(
        "good", F.col("quality") == 1)
    cuts = qr.certified_cutoffs(lab, 0.02, 0.05).collect()
    assert {(c["stratum"], c["rule"]) for c in cuts} == {(s, r) for s in ("en", None) for r in qr.RULES}
    for c in cuts:
        if c["cutoff"] is not None:
            assert c["p"] <= 0.05 / (6 * 2)
            assert c["rejected_junk"] * 0.2 > c["rejected_good"]
    assert any(c["cutoff"] is not None for c in cuts if c["rule"] == "symbols")


def test_too_few_labels_reject_nothing_and_edges(spark):
    docs, labels = _corpus(60)
    docs += [(None, None, None, None), (9999, "", "en", "y"), (9999, "", "en", "y")]
    labels += [(None, 1, 0), (1, 1 - labels[1][1], 0), (2, None, 1)]
    d, lb = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    out = qr.judge(d, lb)
    assert out.columns[:4] == d.columns and out.columns[4] == "n_words"
    rows = out.toDF("doc_id", "text", "lang", "mine", *out.columns[4:]).collect()
    assert len(rows) == 63
    for r in rows:
        n, _, _, _, rep = _counts(r["text"])
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert r["kept"] == (not r["base_failed"])
    assert qr.judge(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    assert qr.judge(d, spark.createDataFrame([], LABELS)).count() == 63
