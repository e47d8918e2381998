import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tests.oracle import compare, duck
from tickforge.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return H("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _brute(rows):
    """One dictionary a row, by the definition: whole trees as lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([_leaf(r) for r in sorted(rs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))])
             for g, rs in groups.items()}
    top = _levels([trees[g][-1][0] for g in order])
    out = []
    for g, rs in groups.items():
        for i, r in enumerate(sorted(rs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))):
            bad = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                bad["n_chars"] += 1
            at, digest, proof = i, _leaf(bad), ""
            for tree in (trees[g], top):
                for level in tree[:-1]:
                    pair = level[at - at % 2:at - at % 2 + 2]
                    proof += "".join(x for k, x in enumerate(pair) if k != at % 2)
                    pair[at % 2] = digest
                    digest, at = H(*pair), at // 2
                at = order.index(g)
            out.append((r["doc_id"], _leaf(r), trees[g][-1][0], top[-1][0], H(proof), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def _rows():
    rows = [dict(doc_id=7 * k, text=f"text {k} äé" * (k % 5), lang=["en", "de", "en", "fr", None, "é", ""][k % 7],
                 source=None if k % 6 == 0 else f"s{k % 3}", n_chars=None if k % 9 == 0 else k, root="clash") for k in range(150)]
    rows += [dict(rows[3]) for _ in range(20)]  # repeated rows
    rows += [dict(doc_id=None, text=None, lang="en", source="", n_chars=2 ** 63 - 1, root=None),
             dict(doc_id=-7, text="x" * 200_000, lang="zz", source="-", n_chars=2 ** 63 - 1, root=None),
             dict(doc_id=21, text="", lang="en", source=None, n_chars=0, root=None)]
    return rows


def _run(df, **kw):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = F.when(crc % 7 == 0, F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return merkle.manifest(df, FIELDS, changes={"n_chars": more}, **kw)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equals_the_definition_for_every_block_size(spark, height):
    rows = _rows()
    got = _run(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5), keep=["doc_id"], height=height)
    seen = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], H("".join(r["siblings"])), r["version_root"],
             r["version_root"] == r["root"]) for r in got.collect()]
    assert sorted(seen, key=str) == _brute(rows)


def test_versions_copy_one_path_and_share_the_rest(spark):
    rows = [dict(doc_id=k, text=str(k), lang="en", source="s", n_chars=k, root="") for k in range(37)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = {r["place"]: r for r in _run(df, height=2).collect()}
    base = _levels([got[i]["leaf"] for i in range(37)])
    changed = [r for r in got.values() if r["copied"] is not None]
    assert changed and all(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 for r in changed)
    for r in changed:
        assert len(r["copied"]) == len(r["sides"]) == len(base) - 1
        leaves = list(base[0])
        leaves[r["place"]] = _leaf(dict(rows[r["doc_id"]], n_chars=rows[r["doc_id"]]["n_chars"] + 1))
        whole = _levels(leaves)  # a rebuilt tree: equal to the shared nodes with the copies put in
        for lvl, new in enumerate(r["copied"], 1):
            shared = list(base[lvl])
            shared[r["place"] >> lvl] = new
            assert whole[lvl] == shared
        assert r["version_root"] == whole[-1][0] != r["root"]


def test_small_groups_and_columns(spark):
    one = spark.createDataFrame([(1, None, None, None, None, "mine")], SCHEMA)
    r = _run(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["version_root"] == H("1:1----")
    assert r["siblings"] == [] and r["sides"] == "" and _run(one).columns.count("root") == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert _run(empty).collect() == []


def test_query_matches_its_oracle(spark):
    ok, msg = compare(E.queries()["op11_manifest"](spark, SF001), duck(SF001), E.oracle_sql()["op11_manifest"])
    assert ok, msg
