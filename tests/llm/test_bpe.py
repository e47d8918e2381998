import hashlib
import random

import numpy as np
import pytest

from tickforge.llm import bpe
from tickforge.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
BITS = ["a", "b", "the", " ", "  ", "\n", "\t", " ", "\u0085", "\x1c", "1", "23", "é", "日本",
        "😀", "'s", "'ll", "<|endoftext|>", "<|endo", "!!", "́", " \n ", "ing", "aaaa", "====="]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_equals_the_library(library):
    ours = bpe.SpeculativeBpe(PATH)
    texts = _texts(3000, 3) + ["", "a" * 20000, "ab" * 9000, " " * 9000, "é" * 5000, "x" * 64, "z" * 65]
    got = ours.encode_batch(texts)
    for t, ids, ref in zip(texts, got, library.encode_batch(texts, add_special_tokens=False)):
        assert ids == np.array(ref.ids, dtype="<u4").tobytes(), t[:80]
        assert ours.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_verification_finds_every_wrong_cut(library):
    ours = bpe.SpeculativeBpe(PATH)
    words = ["".join(random.Random(i).choices("thenardosig", k=9)) for i in range(2000)]
    greedy = [ours._propose(w) for w in words]
    exact = [ours.merge_exactly(w) for w in words]
    assert ours.merge_together(words) == exact
    assert ours.encode_words(words) == exact
    assert any(g != e for g, e in zip(greedy, exact))


def test_decode_of_broken_bytes(library):
    ours = bpe.SpeculativeBpe(PATH)
    ids = [ours.vocab["Ã"], ours.vocab["a"], 50256]
    assert ours.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_frames(spark, library):
    schema = "doc_id long, text string, n_tokens string"
    rows = [(i, t, "x") for i, t in enumerate(_texts(200, 5))] + [(None, None, None), (7, "", "y"), (7, "", "y")]
    docs = spark.createDataFrame(rows, schema)
    enc = bpe.encode(docs, PATH)
    assert enc.columns == ["doc_id", "text", "n_tokens", "ids"]
    back = bpe.decode(enc.drop("text"), PATH).select("doc_id", "n_tokens", "text")
    key = lambda d: sorted(d, key=str)
    assert key((r[0], r[1] or "") for r in rows) == key((r["doc_id"], r["text"]) for r in back.collect())
    dig = {r["doc_id"]: r for r in bpe.digest(docs.filter("doc_id != 7"), PATH, max_bytes=500).collect()}
    for i, t, _ in rows[:200]:
        if i == 7:
            continue
        ids = library.encode(t, add_special_tokens=False).ids
        assert dig[i]["n_tokens"] == len(ids)
        assert dig[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert dig[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.digest(spark.createDataFrame([], schema), PATH).count() == 0
    assert bpe.encode(enc.withColumn("ids", enc.doc_id), PATH).columns == enc.columns
