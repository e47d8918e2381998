import random

from pyspark.sql import functions as F

from tickforge.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _targets(sizes, repeats=3):
    """Brute force: hold sources above their limit, reshare, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in held]
        if not free:
            return held
        share = (total - sum(held.values())) / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] >= repeats * sizes[s]]
        if not over:
            return held | {s: share * weight[s] for s in free}
        held |= {s: repeats * sizes[s] for s in over}


def _docs(spark, spec, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, n, words in spec:
        for _ in range(n):
            rows.append((i, " ".join(["w"] * rng.randint(1, words)), "en", source, 0))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_and_shares(spark):
    docs = _docs(spark, [("a", 300, 9), ("b", 3, 5), (None, 40, 9), ("é", 5, 9), ("z", 900, 9)])
    got = mixing.mix(docs, bucket_rows=50)
    rows = got.collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    want = _targets(sizes)
    taken = {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 10, (s, taken, want)
    assert sum(taken.values()) <= sum(sizes.values())
    assert got.columns == docs.columns + ["size", "source_size", "target", "copies"]


def test_order_is_the_finish_order(spark):
    """Brute force over all copies in one sorted list."""
    docs = _docs(spark, [("a", 60, 30), ("b", 10, 30), ("c", 200, 30)])
    rows = mixing.mix(docs, bucket_rows=7).collect()
    h = {r["doc_id"]: r["h"] for r in docs.select(
        "doc_id", F.xxhash64("doc_id", "text", F.lit(20240)).alias("h")).collect()}
    items = []
    for s in "abc":
        own, cum = sorted((r for r in rows if r["source"] == s), key=lambda r: h[r["doc_id"]]), 0
        for r in own:
            cum += r["size"]
            items += [((e * r["source_size"] + cum) / r["target"], s, r) for e in range(3)]
    budget, left, want = sum(r["size"] for r in rows), sum(r["size"] for r in rows), {}
    for _, _, r in sorted(items, key=lambda x: x[:2]):
        if r["size"] > left:
            break
        left -= r["size"]
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + 1
    assert budget > 0
    assert {r["doc_id"]: r["copies"] for r in rows if r["copies"]} == want


def test_edges(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
            (2, "one two", None, "a", 7), (2, "one two", None, "a", 7), (3, " \t\n", "en", None, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("target", F.lit("mine")).withColumn(
        "h", F.lit(1)).withColumn("size", F.lit("x"))
    got = mixing.mix(docs)
    assert got.count() == 6
    out = got.toDF(*[f"c{i}" for i in range(len(got.columns))]).collect()
    assert all(r["c5"] == "mine" and r["c7"] == "x" for r in out)
    assert sum(r["c8"] * r["c11"] for r in out) == 4  # all of a, its share is the total
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None, "a", None)], SCHEMA)
    assert [r["copies"] for r in mixing.mix(nothing).collect()] == [0]


def test_reruns_agree_and_repeat(spark):
    docs = _docs(spark, [("a", 50, 9), ("b", 4, 9)])
    one = mixing.mix(docs.repartition(3))
    two = mixing.mix(docs.repartition(7, "text"), bucket_rows=3)
    key = lambda d: sorted(map(tuple, d.select("doc_id", "copies").collect()))
    assert key(one) == key(two)
    rep = mixing.repeated(one, docs.columns)
    assert rep.columns == docs.columns
    assert rep.count() == one.agg(F.sum("copies")).first()[0]
