import io
import random
import zlib

import numpy as np
import pytest

from tickforge.llm import bitplane
from tickforge.llm.queries import tokenizer_path
from tickforge.session import scratch_dir

PATH = tokenizer_path("word_bpe_49k.json")


class _Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_round_trip_and_ranges(kind):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 49408, 5000).astype("<u4")
    assert (bitplane.from_planes(bitplane.to_planes(ids, kind), len(ids), kind) == ids).all()
    out = _Memory()
    w = bitplane.Writer(out, kind, block_ids=256)
    cuts, docs = [0, 0, 1, 300, 300, 4999, 5000], []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        docs.append((None if k == 0 else k, a, ids[a:b].tobytes()))
        w.add(docs[-1][0], docs[-1][2])
    w.close()
    r = bitplane.Reader(out)
    assert list(r.documents()) == docs
    assert len(r.chunks) == -(-5000 // 256)
    for a, n in ((0, 5000), (255, 2), (4990, 10), (700, 0)):
        assert (r.ids(a, n) == ids[a:a + n]).all()


def test_damage_is_noticed():
    out = _Memory()
    w = bitplane.Writer(out, block_ids=64)
    w.add(1, np.arange(64, dtype="<u4").tobytes())
    w.chunks[0][3] ^= 1
    w.close()
    with pytest.raises(ValueError):
        bitplane.Reader(out).block(0)
    with pytest.raises(ValueError):
        bitplane.Reader(_Memory(b"x" * 64))


def test_words_equal_whole_texts():
    enc = bitplane.WordEncoder(PATH)
    assert enc.by_word
    rng = random.Random(2)
    bits = ["The", " ", "\n", " ", " ", "\x85", "\x1c", "İ", "Σς", "é", "́", "'s", "'ll",
            "12", "!!", "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "😀", "ﬁ", "\t\t"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(["ab", "It's", "DON'T", "'", "x1", " ", "\x00", "\x7f", "--", "_", "`", "\n"])
                      for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x24f), rng.randint(0xa0, 0xff), 0x20, 0x61]))
                      for _ in range(30)) for _ in range(3000)]
    texts += [chr(c) + "a" for c in range(1, 0x250)] + ["A" + chr(c) for c in range(1, 0x250)]
    whole = enc._run(texts)
    assert enc.encode_batch(texts) == whole


def test_write_and_read(spark):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choices(["alpha", "Beta", "<b>", "été"], k=rng.randint(0, 60))), i)
            for i in range(300)] + [(None, "x", 0), (9, None, 0), (9, "again", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    folder = scratch_dir(spark, "test-ids")
    manifest = bitplane.write_ids(docs, folder, PATH, end_id=1, parts=4, block_ids=128)
    got = sorted(bitplane.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(got) == len(rows)
    assert [r["doc_id"] for r in got] == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    enc = bitplane.WordEncoder(PATH)
    at, want = 0, {(r[0], enc._run([r[1] or ""])[0]) for r in rows}
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        assert bytes(r["ids"][-4:]) == b"\x01\0\0\0" and len(r["ids"]) == 4 * r["n_tokens"]
        assert (r["doc_id"], bytes(r["ids"][:-4])) in want
        assert zlib.crc32(r["ids"]) >= 0


def test_empty_table(spark):
    folder = scratch_dir(spark, "test-ids")
    bitplane.write_ids(spark.createDataFrame([], "doc_id long, text string"), folder, PATH, end_id=1)
    assert bitplane.read_ids(spark, folder).count() == 0
