import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tests.oracle import compare, duck
from tickforge.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, rank string"


def _brute(rows, low=80, high=100, np_=5, nn=5):
    """rows: (id, vector, label); everything in Python's integers."""
    ok = {}
    for k, v, label, *_ in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None), key=lambda r: r[0]):
        if all(c is not None and math.isfinite(c) for c in v):
            ok[k] = ([math.floor(256 * c) for c in v], label)
    out = []
    for a in (k for k in ok if k % 100 == 0):
        scored = [(-sum(x * y for x, y in zip(ok[a][0], ok[b][0])), b) for b in ok if b != a and len(ok[b][0]) == len(ok[a][0])]
        same = sorted(s for s in scored if ok[s[1]][1] == ok[a][1])[:np_]
        other = sorted(s for s in scored if ok[s[1]][1] != ok[a][1])
        for p, b in same:
            fit = [s for s in other if low * -p <= 100 * -s[0] <= high * -p][:nn]
            out += [(a, b, i + 1, n, -p, -s) for i, (s, n) in enumerate(fit)]
    return sorted(out)


def _vectors(seed, n, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(int(k), (centres[k % 6] + rng.normal(size=dim) * rng.choice([0.1, 0.6, 1.5])).tolist(), int(rng.integers(0, 4))) for k in range(n)]
    hot = centres[0].tolist()
    rows += [(n + i, hot, i % 3) for i in range(n // 2)]  # a third of all rows are one vector: ties everywhere
    m = 2 * n
    rows += [(m, None, 1), (m + 1, hot, None), (m + 2, [float("nan")] * dim, 1), (m + 3, [None] + hot[1:], 1),
             (m + 4, [math.inf] * dim, 1), (m + 5, [0.0] * dim, 1), (m + 100, [], 1), (m + 101, [], 1), (m + 102, [], 2),
             (m + 200, [1.0, 2.0], 1), (m + 201, [1.0, 2.0], 1), (m + 202, [1.0, 1.9], 2), (None, hot, 1), (-100, hot, 2)]
    return rows


@pytest.mark.parametrize("share", [64, 100_000])
def test_equals_scoring_all_pairs(spark, share, monkeypatch):
    rows = _vectors(3, 400)
    df = spark.createDataFrame([(k, v, c, "x") for k, v, c in rows], SCHEMA).repartition(6)
    out = hn.mine(df, lambda k: k % 100 == 0, window=16, block=3, group_bytes=share * 160)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == _brute(rows) and len(got) > 50


def test_many_groups(spark, monkeypatch):
    rows = _vectors(8, 300)
    monkeypatch.setattr(hn.math, "ceil", lambda x: max(1, -int(-x // 1)) if x < 3 else 7)
    df = spark.createDataFrame([(k, v, c, "x") for k, v, c in rows], SCHEMA)
    assert sorted(tuple(r) for r in hn.mine(df, lambda k: k % 100 == 0, window=8).collect()) == _brute(rows)


def test_bounds_hold_and_leave_windows_out():
    rng = np.random.default_rng(1)
    centres = np.eye(8)
    x = hn.quantised(np.concatenate([c * 3 + rng.normal(size=(200, 8)) * 0.2 for c in centres]), 256.0)
    refs = hn.directions(list(x[::7]), 8, 16, 1)
    size, near = hn.angles(x, refs)
    near = near.astype("<f4")
    w = hn.Windows(range(len(x)), [str(k // 200) for k in range(len(x))], 8, [hn._packed(v) for v in x], size.tolist(),
                   [a.tobytes() for a in near], 32)
    some = np.arange(0, len(x), 50)
    low, high = w.bounds(near[some].astype(float), size[some])
    for j, (a, z) in enumerate(w.spans):
        s = x[some] @ x[w.keys[a:z]].T
        assert (s >= low[:, [j]]).all() and (s <= high[:, [j]]).all()
    facts = {"key": some, "label": np.array([str(k // 200) for k in some], dtype=object), "q": x[some], "size": size[some],
             "near": near[some].astype(float), "bands": [[int(s * s * 0.9)] for s in size[some]]}
    list(hn._negatives(w, facts, 5, 80, 100))
    assert w.scored < 0.3 * w.seen


def test_scores_beyond_doubles(spark):
    big = [(0, [1e12, 3.0, -1e12], 1), (1, [1e12, 2.0, -1e12], 1), (2, [1e12, 1.0, -9e11], 2), (3, [8e11, 0.5, -9.1e11], 2), (4, [1e300] * 3, 2)]
    df = spark.createDataFrame([(k, v, c, "x") for k, v, c in big[:2]], SCHEMA)
    assert hn.mine(df, lambda k: k % 100 == 0).collect() == []
    small = [(k, [c / 1e8 for c in v], lab) for k, v, lab in big[:4]]
    mid = [(k, [c / 1e6 for c in v], lab) for k, v, lab in big[:4]]  # sums beyond 2**53, within 64 bits
    for rows in (small, mid):
        df = spark.createDataFrame([(k, v, c, "x") for k, v, c in rows], SCHEMA)
        assert sorted(tuple(r) for r in hn.mine(df, lambda k: k % 100 == 0).collect()) == _brute(rows)
    df = spark.createDataFrame([(k, v, c, "x") for k, v, c in big], SCHEMA)  # held at the limits, no failure
    assert {r["positive_score"] for r in hn.mine(df, lambda k: k % 100 == 0).collect()} == {2 ** 63 - 1}


def test_repeated_rows_and_empty_table(spark):
    rows = _vectors(5, 120)
    df = spark.createDataFrame([(k, v, c, "x") for k, v, c in rows + rows[:40]], SCHEMA)
    assert sorted(tuple(r) for r in hn.mine(df, lambda k: k % 100 == 0).collect()) == _brute(rows)
    assert hn.mine(spark.createDataFrame([], SCHEMA), lambda k: k % 100 == 0).collect() == []


def test_query_matches_its_oracle(spark):
    ok, msg = compare(E.queries()["op12_hard_negatives"](spark, SF001), duck(SF001), E.oracle_sql()["op12_hard_negatives"])
    assert ok, msg
