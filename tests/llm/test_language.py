import random
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import language as lg
from tickforge.llm import queries

from tests.conftest import SF001 as SF


def test_gradients_equal_differences():
    net = lg.BiGru.fresh(["a", "b", "c"], 4, 3, 1)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    x, size = lg._matrix([lg.letters(t) for t in ("ab", "abcé de", "z")])
    target = np.array([0, 2, 1])
    counts = lg.counting(x, np.array([0, 3, 0]), size)
    _, g = net.gradients(x, size, target, counts)
    rng = np.random.default_rng(0)
    for k, v in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in v.shape)
            if k == "e":
                at = (rng.choice([97, 98, 256, 257]), at[1])
            keep, eps = v[at], 1e-3
            v[at] = keep + eps
            up, _ = net.gradients(x, size, target, counts)
            v[at] = keep - eps
            down, _ = net.gradients(x, size, target, counts)
            v[at] = keep
            assert abs((up - down) / (2 * eps) - g[k][at]) < 2e-4, k


def _text(rng, lang, n):
    words = {"xx": ["kra", "kru", "okr", "rkak"], "yy": ["limi", "ölö", "meli", "ili"]}[lang]
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return lg.train([(_text(rng, x, 30), x) for x in ("xx", "yy") * 40], steps=120)


def test_learns_and_reruns_agree(model):
    rng = random.Random(2)
    cases = [(_text(rng, x, n), x) for x in ("xx", "yy") for n in (1, 5, 2000)]
    names, scores = model.predict([t for t, _ in cases])
    assert names == [x for _, x in cases]
    assert all(0.5 < s <= 1 for s in scores)
    rng = random.Random(1)
    again = lg.train([(_text(rng, x, 30), x) for x in ("xx", "yy") * 40], steps=120)
    assert all((again.p[k] == v).all() for k, v in model.p.items())


def _step(p, d, state, symbol):
    """One step of one direction, in plain double arithmetic."""
    h = len(state)
    a = p["e"][symbol].astype(float) @ p[f"w{d}"].astype(float) + p[f"b{d}"]
    zr = 1 / (1 + np.exp(-(a[:2 * h] + state @ p[f"u{d}"].astype(float))))
    z, r = zr[:h], zr[h:]
    return state + z * (np.tanh(a[2 * h:] + (r * state) @ p[f"c{d}"].astype(float)) - state)


def _log_probs(net, symbols):
    """Of every position, with the state carried over all symbols, byte by byte."""
    states = {}
    for d, order in (("f", range(len(symbols))), ("b", range(len(symbols) - 1, -1, -1))):
        state = np.zeros(net.h)
        for i in order:
            state = states[d, i] = _step(net.p, d, state, symbols[i])
    y = np.array([np.concatenate([states["f", i], states["b", i]]) for i in range(len(symbols))]) @ net.p["o"] + net.p["ob"]
    return y - np.log(np.exp(y).sum(1, keepdims=True))


def _symbols(text):
    """Bytes of letters and marks, single spaces between runs, by Unicode category."""
    runs, held = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c)[0] in "LM":
            held += c
        else:
            if any(unicodedata.category(x)[0] == "L" for x in held):
                runs.append(held)
            held = ""
    return [256, *" ".join(runs).encode(), 257] if runs else []


TEXT = "Kra limi, " + "ölö" * 170 + " rkak 12 ## e\u0301te\u0301 " + "limi kra " * 30 + "हिन्दी"


def test_pooling_is_over_all_letters_of_all_windows(model):
    """Brute force: every window on its own, byte by byte, and every letter counted once."""
    symbols = _symbols(TEXT)
    assert symbols == lg.letters(TEXT).tolist()
    total, seen = np.zeros(2), []
    for lo, a, b, hi in lg.windows(lg.letters(TEXT)):
        assert lo <= a < b <= hi and (a == 0 or a - lo >= lg.CONTEXT or lo == 0) and (hi - b >= lg.CONTEXT or hi == len(symbols))
        assert all(i in (0, len(symbols)) or symbols[i] & 0xC0 != 0x80 or symbols[i] > 255 for i in (lo, a, b, hi))
        y = _log_probs(model, symbols[lo:hi])
        at = [i for i in range(a, b) if symbols[i] < 256 and symbols[i] != 32]
        seen += at
        total += y[[i - lo for i in at]].sum(0)
    assert seen == [i for i, x in enumerate(symbols) if x < 256 and x != 32]
    prob = np.exp(total / len(seen)) / np.exp(total / len(seen)).sum()
    names, scores = model.predict([TEXT])
    assert abs(scores[0] - prob.max()) < 1e-4 and names[0] == model.labels[int(prob.argmax())]


def test_windows_carry_the_state_of_the_text(model):
    """The context brings the states close to those carried over the whole text; without it they are far off."""
    rng = random.Random(4)
    symbols = lg.letters(_text(rng, "xx", 60) + " " + _text(rng, "yy", 60))
    want = np.exp(_log_probs(model, symbols))
    off = {}
    for context in (0, lg.CONTEXT):
        got = np.zeros_like(want)
        for lo, a, b, hi in lg.windows(symbols, 32, context):
            x, size = lg._matrix([symbols[lo:hi]])
            y, _ = model.log_probs(x, size)
            got[a:b] = np.exp(y[a - lo:b - lo, 0])
        off[context] = np.abs(got - want).max()
    assert off[lg.CONTEXT] < 0.05 and off[lg.CONTEXT] < off[0]


def test_letters_and_marks_by_category(model):
    assert model.predict(["² ½ ³", "12 ٣ _ #", "\u0301 \u0301", "", None]) == (["und"] * 5, [0.0] * 5)
    assert lg.letters("été 3x").tolist() == [256, *"été x".encode(), 257]
    assert lg.letters("e\u0301te\u0301").tolist() == [256, *"e\u0301te\u0301".encode(), 257]  # marks stay with their letters
    cut = lg.windows(lg.letters("ж" * 500))
    assert {b - a for _, a, b, _ in cut[1:-1]} == {224} and len(cut) == 5


def test_edges(spark, model):
    schema = "doc_id long, text string, lang string, score2 int"
    rows = [(1, None, "a", 1), (1, "", None, None), (None, "12 # _ ٣", None, 2), (4, "kra" * 20000, "b", 3),
            (4, "kra" * 20000, "b", 3)]
    out = lg.identify(spark.createDataFrame(rows, schema), model)
    got = out.collect()
    assert sorted((r["lang_pred"], r["score"] > 0.5) for r in got) == [
        ("und", False)] * 3 + [("xx", True)] * 2
    assert lg.identify(spark.createDataFrame([], schema), model).count() == 0
    again = lg.identify(out.withColumn("score", F.lit("mine")), model)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    nothing = lg.fit(spark.createDataFrame([], schema))
    assert {r["lang_pred"] for r in lg.identify(spark.createDataFrame(rows, schema), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = queries.op10_language(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97


def test_sample_is_bounded(spark):
    from tickforge.llm.training import sample_rows

    df = spark.range(3000).select(F.col("id").alias("k"), F.repeat(F.lit("ab "), 100).alias("text"),
                                  F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"))
    got = sample_rows(df, 50, 20, 1)
    assert len(got) == 100 and all(len(t) == 20 for t, _ in got)
    assert got == sample_rows(df.repartition(9), 50, 20, 1)
    assert {len(t) for t, _ in sample_rows(df, 5, None, 1)} == {300} and {y for _, y in sample_rows(df, 5, None, 1, 1)} == {"b"}
