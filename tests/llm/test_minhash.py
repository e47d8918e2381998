import random

import numpy as np

from tickforge.llm import minhash
from tickforge.llm.components import connected_components


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text, width):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def _brute(rows, width, percent):
    sets = {k: _shingles(t, width) for k, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, _components(sets, links)


def _corpus(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "ÉTÉ", "The", "THE"]
    base = [[rng.choice(vocab) for _ in range(rng.randint(1, 120))] for _ in range(n)]
    texts = [" ".join(b) for b in base]
    for b in base[: n // 3]:
        for _ in range(rng.randint(1, 6)):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(c) // 25))):
                c[rng.randrange(len(c))] = rng.choice(vocab)
            texts.append(rng.choice([" ", "\n", "\t "]).join(c))
    chain = [f"c{i}" for i in range(200)]  # every version is like the one before only
    for k in range(60):
        chain = chain[4:] + [f"n{k}-{i}" for i in range(4)]
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts + ["", " \n ", "one", "ONE", "one two", "One  two"]))


def test_equals_brute_force(spark):
    for width, percent, block in ((3, 85, 16), (5, 80, 128)):
        rows = _corpus(150, width)
        docs = spark.createDataFrame([*rows, (len(rows), None)], "doc_id long, text string").repartition(4)
        sets, comp = _brute([*rows, (len(rows), None)], width, percent)
        got = minhash.near_duplicates(docs, width=width, percent=percent, block=block).collect()
        assert len(got) == len(rows) + 1
        for r in got:
            assert r["n_shingles"] == len(sets[r["doc_id"]])
            assert r["component_id"] == comp[r["doc_id"]]
            assert r["kept"] == (comp[r["doc_id"]] == r["doc_id"])


def test_edges(spark):
    schema = "doc_id long, text string, component_id string, n int"
    docs = spark.createDataFrame([(None, "a b c d e", "x", 1), (None, "a b c d e", "x", 1), (5, "a b c d e", "x", 1),
                                  (7, "A B C d e", None, None), (7, "A B C d e", None, None)], schema)
    got = sorted(minhash.near_duplicates(docs).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [
        (5, 5, True), (7, 5, False), (7, 5, False), (None, None, True), (None, None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_forest_spans_the_links():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(40)]
    links = [(i, j) for i in range(40) for j in range(i + 1, 40)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 50 * len(np.union1d(sets[i], sets[j]))]
    got = minhash.forest(sets, 50)
    assert set(got) <= set(links)
    assert _components(range(40), got) == _components(range(40), links)
    side = np.arange(40) % 2
    across = [(i, j) for i, j in links if side[i] != side[j]]
    assert _components(range(40), minhash.forest(sets, 50, side)) == _components(range(40), across)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 500)] + [(7, 7), (3, 2), (2, 3)]
    rng = random.Random(1)
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    assert got == _components(set(range(201)) | set(range(1000, 1500)), links)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
