import math

import numpy as np

from tests.llm.test_minhash import _components
from tickforge.llm import embedding_dedup as ed
from tickforge.llm.common import table
from tickforge.llm.queries import op2_embedding_dedup

from tests.conftest import SF001 as SF

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def _brute(vectors, threshold=0.95):
    """vectors: id -> list; links by plain double arithmetic."""
    ok = {}
    for k, v in vectors.items():
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(np.float64)
            ok[k] = x / np.sqrt((x * x).sum())
    ids = sorted(ok)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold]
    n = dict.fromkeys(vectors, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return links, n, _components(vectors, links)


def _vectors(seed, n, dim=24):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        base = rng.normal(size=dim)
        out.append(base)
        for _ in range(rng.integers(0, 5) if k % 3 else 0):
            out.append(base * rng.uniform(0.1, 5) + rng.normal(size=dim) * rng.uniform(0, 0.35))
    dense = rng.normal(size=dim)
    out += [dense + rng.normal(size=dim) * 0.2 for _ in range(400)]   # wider than a window
    out += [dense] * 50 + [np.zeros(dim)] * 3 + [np.full(dim, 1e38)] * 2 + [np.full(dim, -1e-38)] * 2
    order = rng.permutation(len(out))
    return {int(i): [float(np.float32(c)) for c in out[j]] for i, j in enumerate(order)}


def test_recall_and_exact_counts(spark):
    vectors = _vectors(1, 400)
    k = len(vectors)
    vectors |= {k: None, k + 1: [], k + 2: [1.0, None] * 12, k + 3: [float("nan")] * 24, k + 4: [float("inf")] * 24,
                k + 5: [1.0, 2.0], k + 6: [2.0, 4.0], k + 7: [2.0, -4.0]}
    df = spark.createDataFrame([(i, v, i % 3, "x") for i, v in vectors.items()], SCHEMA).repartition(5)
    got = {r["vec_id"]: r for r in ed.near_duplicates(df, window=32, block=64).collect()}
    links, n, comp = _brute(vectors)
    assert set(got) == set(vectors)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * 2 * len(links)
    for i, r in got.items():
        assert r["n_links"] <= n[i] and r["kept"] == (r["component_id"] == i)
        assert comp[r["component_id"]] == comp[i]
    same = sum(r["component_id"] == comp[i] for i, r in got.items())
    assert same >= 0.99 * len(vectors)


def test_pairs_inside_a_dense_region_below_the_threshold(spark):
    """A third of all vectors at a cosine of about 0.87 to one another, where nearly all signs agree."""
    rng = np.random.default_rng(4)
    dim, n = 64, 900
    out = [rng.normal(size=dim) for _ in range(2 * n)]
    axis = np.eye(dim)[0] * 2.6
    side = rng.normal(size=(n, dim)) / np.sqrt(dim)
    planted = [axis + 0.8 * r + 0.6 * rng.normal(size=dim) / np.sqrt(dim) for r in side[:60]]
    out += [axis + r for r in side] + planted
    rows = {i: [float(np.float32(c)) for c in v] for i, v in enumerate(out)}
    links, n_links, comp = _brute(rows)
    assert 40 <= len(links) < 200
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows.items()], SCHEMA).repartition(4)
    got = {r["vec_id"]: r for r in ed.near_duplicates(df, window=8, block=64).collect()}
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * 2 * len(links)
    assert sum(got[i]["component_id"] == comp[i] for i in rows) >= len(rows) - 0.02 * len(links)


def test_passes_follow_the_number_of_vectors():
    assert ed.n_passes(1000, 128, 0.95, 0.01) < ed.n_passes(10**6, 128, 0.95, 0.01) < ed.n_passes(10**10, 128, 0.95, 0.01)
    assert ed.n_passes(10**10, 128, 0.95, 0.01) < 200


def test_edges(spark):
    rows = [(None, [1.0, 0.0], 1, None), (None, [1.0, 0.0], 1, None), (4, [1.0, 0.0], None, "a"), (9, [2.0, 0.0], 1, "b"),
            (9, [2.0, 0.0], 1, "b"), (7, [-0.0, 1.0], 1, "c"), (8, [0.0, 1.0], 1, "c")]
    got = sorted(ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    assert [(r["vec_id"], r["component_id"], r["kept"]) for r in got] == [
        (4, 4, True), (7, 7, True), (8, 7, False), (9, 4, False), (9, 4, False), (None, None, True), (None, None, True)]
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    rows = table(spark, SF, "embeddings").collect()
    _, n, comp = _brute({r["vec_id"]: r["embedding"] for r in rows})
    got = op2_embedding_dedup(spark, SF).collect()
    assert len(got) == len(rows)
    assert all((r["n_links"], r["component_id"]) == (n[r["vec_id"]], comp[r["vec_id"]]) for r in got)
