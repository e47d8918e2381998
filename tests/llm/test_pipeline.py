import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.conftest import SF001 as SF
from tests.llm.test_minhash import _brute
from tickforge.llm.common import stored
from tickforge.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 400")
    extra = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "12 34 ##", "en", None, 8),
                                   (9003, "mail me at jane.doe@corp.example.org please", None, None, 43)],
                                  docs.schema)
    out = [stored(docs.union(extra), "test-docs")]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return [s.collect() for s in out], [s.columns for s in out]


def test_columns_and_order(steps):
    rows, columns = steps
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "surrogates", "mix", "tokens"]
    assert all(c == COLUMNS for c in columns[:-1])
    assert columns[-1] == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]


def test_each_stage(steps):
    docs, lang, dedup, clean, mixed, tokens = steps[0]
    gone = {r["doc_id"] for r in docs} - {r["doc_id"] for r in lang}
    assert gone == {r["doc_id"] for r in docs if not any(c.isalpha() for c in r["text"] or "")}
    assert all(r["lang"] for r in lang)

    _, comp = _brute([(r["doc_id"], r["text"]) for r in lang], 5, 80)
    assert {r["doc_id"] for r in dedup} == {k for k, c in comp.items() if k == c}

    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in dedup}
    before = {r["doc_id"]: r["text"] for r in dedup}
    assert all(len(r["text"]) == r["n_chars"] for r in clean)
    assert "jane.doe" not in next(r["text"] for r in clean if r["doc_id"] == 9003)
    same = sum(r["text"] == before[r["doc_id"]] for r in clean)
    assert 0 < len(clean) - same < len(clean) / 2

    texts = {(r["doc_id"], r["text"]) for r in clean}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= texts
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert words(clean) - 5000 <= words(mixed) <= words(clean)

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert len(tokens) == len(mixed) and all(r["round_trip"] for r in tokens)
    ids = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in mixed}
    for r in tokens:
        raw = b"".join(i.to_bytes(4, "little") for i in ids[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(raw) // 4, hashlib.sha256(raw).hexdigest())


def test_run_and_empty_table(spark, tmp_path):
    empty = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
