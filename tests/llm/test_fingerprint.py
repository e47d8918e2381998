import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF001
from tickforge.llm import fingerprint as fp
from tickforge.llm.common import table
from tickforge.llm.queries import op13_fingerprint

SCHEMA = "doc_id long, text string, fingerprint string"


def _hash(word, j):
    """The 64-bit hash of (hash of the word, j): each value's hash seeds the next one's."""
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    first = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(int(j).to_bytes(4, "little"), first)


def _pair(h):
    return ((h & 0xFFFFFFFF) + 0.5) * ((h >> 32) + 0.5) * 2.0 ** -64


def _sampled(text, samples=fp.SAMPLES):
    """Consistent weighted sampling word by word, by its definition."""
    bag = Counter(w for w in re.split(r"[\x20\x09-\x0D]", text or "") if w)
    out = []
    for j in range(samples if bag else 0):
        found = []
        for word, n in bag.items():
            r = -math.log(_pair(_hash(word, 3 * j)))
            c = -math.log(_pair(_hash(word, 3 * j + 1)))
            h = _hash(word, 3 * j + 2)
            b = (h >> 11) * 2.0 ** -53
            t = math.floor(math.log(n) / r + b)
            log_a = math.log(c) - r * (t - b + 1)
            found.append((math.floor((log_a + 128) * 2 ** 23), (h ^ ((t & 0x7FFFFFFF) * 2654435761)) & 0xFFFFFFFF))
        out.append(min(found)[1])
    return out


def _jaccard(a, b):
    a, b = (Counter(x.split()) for x in (a, b))
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


def _brute(rows):
    """(doc_id, n_chars, edited text, next text) of every row, in the order of ids, then as given."""
    texts = [(k, t or "") for k, t in rows]
    out = []
    for i, (k, t) in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)][1]
        half = len(t) // 2
        out.append((k, len(t), t[:len(t) - half] + nxt[:half], nxt))
    return out


def _like(a, b):
    return 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / fp.SAMPLES


ROWS = [(None, "before all"), (1, "a b c a a d é 😀 漢字 x" * 3), (2, ""), (3, None), (4, " \t\n"), (5, "word " * 500),
        (6, "a b c d e f"), (7, "a b c d e f"), (8, "x" * 5000), (9, " ".join(f"w{k}" for k in range(3000))), (10, "odd")]


def test_equals_the_definition(spark):
    df = spark.createDataFrame([(k, t, "clash") for k, t in ROWS], SCHEMA).repartition(4)
    got = {r["doc_id"]: r for r in fp.edited_likeness(df).collect()}
    want = _brute(ROWS)
    assert len(got) == len(want) == len(ROWS)
    for (k, n, edited, nxt), (_, text) in zip(want, ROWS):
        r = got[k]
        own, new = _sampled(text), _sampled(edited)
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in own)
        assert r["edited_fingerprint"] == "".join(f"{x:08x}" for x in new)
        assert r["near_edited"] == _like(own, new) and r["near_next"] == _like(own, _sampled(nxt))


def test_repeated_rows_single_rows_and_empty_tables(spark):
    rows = [(1, "a b c d")] * 3 + [(2, "e f g h"), (2, "e f g i")]
    df = spark.createDataFrame([(k, t, "") for k, t in rows], SCHEMA)
    got = [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in fp.edited_likeness(df, samples=16).collect()]
    again = hashlib.sha256(b"a b a b").hexdigest()
    assert len(got) == 5 and got.count((1, again, 1.0)) == 2
    one = spark.createDataFrame([(5, "a b c d", "")], SCHEMA)
    r = fp.edited_likeness(one, samples=16).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == again
    empty = spark.createDataFrame([], SCHEMA)
    assert fp.edited_likeness(empty, samples=16).collect() == [] and fp.fingerprint(empty, samples=16).collect() == []


def test_fingerprint_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(k, t, "clash") for k, t in ROWS + ROWS[:3]], SCHEMA)
    out = fp.fingerprint(df)
    assert out.columns == ["doc_id", "text", "fingerprint"]
    got = out.collect()
    assert len(got) == len(ROWS) + 3
    for r in got:
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in _sampled(r["text"]))


def test_agreement_estimates_generalised_jaccard(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    rows, want = [], []
    for k in range(60):
        a = rng.choice(words, 200, p=rng.dirichlet(np.ones(60))).tolist()
        b = a[:rng.integers(0, 200)] + rng.choice(words, 100).tolist()
        rows.append((k, " ".join(a), " ".join(b)))
        want.append(_jaccard(rows[-1][1], rows[-1][2]))
    df = spark.createDataFrame(rows, "k long, a string, b string")
    a = fp.signatures(df.select("k", F.col("a").alias("text")), ["k"], samples=256)
    b = fp.signatures(df.select(F.col("k").alias("j"), F.col("b").alias("text")), ["j"], samples=256).withColumnRenamed("signature", "other")
    got = {r["k"]: r["like"] for r in a.join(b, F.col("k") == F.col("j")).select("k", fp.likeness("signature", "other").alias("like")).collect()}
    errors = np.array([got[k] - want[k] for k in range(60)])
    known = fp.common_samples(df.select(F.col("a").alias("text")), 256, rows=20, words=40)
    assert known.count() == 40
    c = fp.signatures(df.select("k", F.col("a").alias("text")), ["k"], samples=256, common=known)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, a.collect()))  # a table of known draws changes nothing
    assert np.abs(errors).max() < 0.13 and abs(errors.mean()) < 0.015  # 4 and 3 standard deviations


def test_registered_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents").orderBy("doc_id").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in op13_fingerprint(spark, SF001).collect()}
    want = _brute(docs)
    assert len(got) == len(want)
    errors = []
    for k, n, edited, nxt in want:
        assert got[k]["n_chars"] == n and got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    for (k, text), (_, _, edited, nxt) in list(zip(docs, want))[::25]:
        assert got[k]["fingerprint"] == "".join(f"{x:08x}" for x in _sampled(text))
        errors += [got[k]["near_edited"] - _jaccard(text or "", edited), got[k]["near_next"] - _jaccard(text or "", nxt)]
    assert abs(np.mean(errors)) < 0.04
