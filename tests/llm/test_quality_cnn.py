import random
import zlib

import numpy as np

from tickforge.llm import quality_cnn as qc
from tickforge.llm import queries

from tests.conftest import SF001 as SF


def test_gradients_equal_differences():
    net = qc.ByteCnn.fresh(3, 2, 4, 1)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    texts, y = [b"hello world " * 40, b"", b"x!" * 30], np.array([1.0, 0.0, 1.0])
    _, g = net.gradients(texts, y)
    rng = np.random.default_rng(0)
    for k, v in net.p.items():
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in v.shape)
            if k == "e":
                at = (rng.choice([104, 33, 120, 256]), at[1])
            keep, eps = v[at], 1e-5
            v[at] = keep + eps
            up, _ = net.gradients(texts, y)
            v[at] = keep - eps
            down, _ = net.gradients(texts, y)
            v[at] = keep
            assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-5, k


def test_gradients_of_whole_texts_whatever_the_pieces():
    """A text much longer than a piece gives the same loss and gradients, stretch by stretch."""
    net = qc.ByteCnn.fresh(3, 2, 4, 1)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abc de!") for _ in range(n)) for n in (30_000, 200, 0, 5000)]
    y = np.array([1.0, 0.0, 1.0, 0.0])
    loss, want = net.gradients(texts, y, piece=10 ** 9)
    for piece in (128, 1000, 4096):
        got, g = net.gradients(texts, y, piece)
        assert abs(got - loss) < 1e-12 and all(np.allclose(g[k], want[k], atol=1e-12) for k in want), piece


def _brute(net, text):
    """One chunk after the other, one filter place after the other."""
    raw = (text or "").encode()
    n = qc.halves(raw)
    row = list(raw) + [qc.PAD] * (n * qc.HALF + qc.WIDTH - len(raw))
    logits = []
    for c in range(n - 1):
        values = []
        for i in range(c * qc.HALF, c * qc.HALF + qc.CHUNK, qc.STRIDE):
            values.append(np.concatenate([net.p["e"][b] for b in row[i:i + qc.WIDTH]]) @ net.p["w"])
        top = np.max(values, axis=0)
        logits.append(np.tanh(top @ net.p["h"] + net.p["hb"]) @ net.p["o"] + net.p["ob"][0])
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_scores_equal_brute_force_whatever_the_pieces():
    net = qc.ByteCnn.fresh(5, 3, 4, 2)
    rng = random.Random(1)
    texts = [None, "", "a"] + ["".join(rng.choice("ab é!") for _ in range(n))
                               for n in (7, 127, 128, 129, 256, 257, 900, 3000, 5000)]
    want = [_brute(net, t) for t in texts]
    for piece in (1_000_000, 256, 512, 1024):
        assert np.allclose(net.scores(texts, piece), want, atol=1e-5), piece


def test_edges(spark):
    net = qc.ByteCnn.fresh(4, 2, 3, 1)
    schema = "doc_id long, text string, x string"
    rows = [(1, None, "a"), (None, "", None), (2, "t " * 50000, "b"), (2, "t " * 50000, "b")]
    out = qc.classify(spark.createDataFrame(rows, schema), net).collect()
    assert len(out) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert qc.classify(spark.createDataFrame([], schema), net).count() == 0
    clash = qc.classify(spark.createDataFrame(rows, "doc_id long, text string, score string"), net)
    assert clash.columns == ["doc_id", "text", "score", "predicted"] and clash.dtypes[2] == ("score", "double")
    empty = qc.fit(spark.createDataFrame([], schema), spark.createDataFrame([], "doc_id long, quality int"))
    assert set(empty.p) == set(net.p)


def test_held_out_accuracy(spark):
    got = queries.op4_quality_cnn(spark, SF).join(
        spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["quality"] is not None]
    good = np.mean([r["predicted"] for r in held if r["quality"] == 1])
    junk = np.mean([1 - r["predicted"] for r in held if r["quality"] == 0])
    assert good >= 0.9 and junk >= 0.8
