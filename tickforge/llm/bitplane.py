"""Token-id files: bit-plane shuffled blocks under zstandard with a chunk index.

File layout (all numbers little-endian)::

    magic  b"TFPLANE1"
    planes of block 0, planes of block 1, ...   each plane compressed on its own
    document index (zstandard): keys int64, null flags uint8, lengths int64
    chunk index (zstandard, JSON): block size, plane kind, for each block its
        number of ids, offset, plane lengths and crc32; place of the document index
    footer: length of the chunk index uint64, magic

A block holds ``block_ids`` ids (the last one fewer). Its ids are transposed into 4
byte planes or 32 bit planes, so equal high bytes lie together and compress to almost
nothing; planes of zeros take no space. The chunk index allows reading any range of
ids without touching other blocks.

The job range-partitions the documents by key, so the files' names sort in key order.
Each task writes its file under a temporary name and renames it at the end: a repeated
task replaces its own file by the same bytes. Files go through ``pyarrow.fs`` to the
folder's own file system; the folder must be shared by all executors.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.bpe import byte_chars, small_batches
from tickforge.llm.common import python_map

MAGIC = b"TFPLANE1"
BLOCK_IDS = 65_536


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Transpose ids (uint32) into 4 byte planes or 32 bit planes, low plane first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if kind == "byte":
        return [p.tobytes() for p in ids.view(np.uint8).reshape(-1, 4).T]
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(p, bitorder="little").tobytes() for p in bits.T]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    """Undo :func:`to_planes`; an empty plane stands for zeros."""
    if kind == "byte":
        out = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            if p:
                out[:, k] = np.frombuffer(p, dtype=np.uint8)
        return out.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), dtype=np.uint8)
    for k, p in enumerate(planes):
        if p:
            bits[:, k] = np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Writes one file as a stream; holds one block and the document index."""

    def __init__(self, out, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        import zstandard

        self.out, self.kind, self.block_ids = out, kind, block_ids
        self.zip = zstandard.ZstdCompressor(level=level).compress
        self.pending: list[bytes] = []
        self.n_pending = 0
        self.chunks: list[list] = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self.at = self.out.write(MAGIC) and len(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.pending.append(ids)
        self.n_pending += len(ids) // 4
        if self.n_pending >= self.block_ids:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), dtype="<u4")
        end = len(ids) if all_of_it else len(ids) - len(ids) % self.block_ids
        for i in range(0, end, self.block_ids):
            block = ids[i:min(end, i + self.block_ids)]
            planes = [self.zip(p) if np.frombuffer(p, np.uint8).any() else b"" for p in to_planes(block, self.kind)]
            self.chunks.append([len(block), self.at, [len(p) for p in planes], zlib.crc32(block.tobytes())])
            for p in planes:
                self.out.write(p)
                self.at += len(p)
        self.pending = [ids[end:].tobytes()]
        self.n_pending = len(ids) - end

    def close(self) -> None:
        self._flush(True)
        flags = np.array([k is None for k in self.keys], dtype=np.uint8)
        docs = self.zip(np.array([k or 0 for k in self.keys], dtype="<i8").tobytes() + flags.tobytes()
                        + np.array(self.lengths, dtype="<i8").tobytes())
        self.out.write(docs)
        index = self.zip(json.dumps({
            "block_ids": self.block_ids, "planes": self.kind, "chunks": self.chunks,
            "docs": [len(self.keys), self.at, len(docs)]}).encode())
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)


class Reader:
    """Random access to one file through its chunk index."""

    def __init__(self, source):
        import zstandard

        self.src, self.unzip = source, zstandard.ZstdDecompressor().decompress
        size = source.size()
        tail = self._at(size - 16, 16)
        if self._at(0, 8) != MAGIC or tail[8:] != MAGIC:
            raise ValueError("not a token-id file")
        n = struct.unpack("<Q", tail[:8])[0]
        index = json.loads(self.unzip(self._at(size - 16 - n, n)))
        self.kind, self.block_ids, self.chunks = index["planes"], index["block_ids"], index["chunks"]
        n_docs, at, length = index["docs"]
        raw = self.unzip(self._at(at, length)) if n_docs else b""
        self.null = np.frombuffer(raw, np.uint8, n_docs, 8 * n_docs).astype(bool)
        self.keys = np.frombuffer(raw, "<i8", n_docs)
        self.lengths = np.frombuffer(raw, "<i8", n_docs, 9 * n_docs)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.src.seek(offset)
        return self.src.read(n)

    def block(self, k: int) -> np.ndarray:
        n, at, lengths, crc = self.chunks[k]
        raw, planes = self._at(at, sum(lengths)), []
        for m in lengths:
            planes.append(self.unzip(raw[:m]) if m else b"")
            raw = raw[m:]
        ids = from_planes(planes, n, self.kind)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of this file, reading only their blocks."""
        if not n:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return got[start - first * self.block_ids:][:n]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Every document in file order: key, place of its first id, its ids; one block is held."""
        blocks = (self.block(k) for k in range(len(self.chunks)))
        have = np.zeros(0, dtype="<u4")
        for i in range(len(self.keys)):
            parts, need = [], int(self.lengths[i])
            while need:
                if not len(have):
                    have = next(blocks)
                parts.append(have[:need])
                need -= len(parts[-1])
                have = have[len(parts[-1]):]
            yield (None if self.null[i] else int(self.keys[i]), int(self.starts[i]),
                   b"".join(p.tobytes() for p in parts))


def _latin(kind: str) -> str:
    """Regex ranges of the characters below U+0250 in a Unicode category."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


class WordEncoder:
    """Whole-text encoding with the tokenizers library, one model call per distinct word.

    The library's own steps (normaliser, word pattern, model) are run, but each on what is
    new: equal words are merged once. This needs a tokenizer file whose normaliser works
    character by character, whose word pattern never crosses white space and drops it, and
    which adds nothing afterwards (checked; other files go through ``encode_batch``).
    """

    PIECE = re.compile(r"[^\t-\r ]+")
    #: Texts of ASCII and precomposed Latin letters need no Unicode normaliser: they are
    #: NFC already, and their lower case is the same everywhere (the dotted I is left out).
    PLAIN = re.compile("[!-~\t-\r \u00a1-\u012f\u0131-\u017f]*")
    #: The file's word pattern for such texts in lower case.
    PLAIN_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_latin('L')}]+|[{_latin('N')}]"
                            f"|[^\\t-\\r {_latin('L')}{_latin('N')}]+")
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    REMEMBERED = 300_000  # words kept between batches (a memory bound, not a cap on input)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["normalizer"]["normalizers"] if spec["normalizer"] else []
        cuts = spec["pre_tokenizer"].get("pretokenizers", [])
        self.by_word = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"].get("Regex") == r"\s+" and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"].get("Regex") == self.PATTERN
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
            and not spec["post_processor"])
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.added = self.tokenizer.model, [t["content"] for t in spec["added_tokens"]]
        self.words: dict[str, bytes] = {}
        self.plain_words: dict[str, bytes] = {}
        self.show = dict(enumerate(byte_chars()))
        self.pieces: dict[str, bytes] = {}

    def _run(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _join(self, words: list[str], shown: bool) -> bytes:
        """Ids of words that went through normaliser and pattern; ``shown``: as byte characters."""
        known = self.words if shown else self.plain_words
        ids = list(map(known.get, words))
        for k in [k for k, x in enumerate(ids) if x is None]:
            w = words[k]
            if w not in known:
                as_bytes = w if shown or w.isascii() else w.encode("utf-8").decode("latin-1").translate(self.show)
                t = self.model.tokenize(as_bytes)
                known[w] = struct.pack(f"<{len(t)}I", *[x.id for x in t])
            ids[k] = known[w]
        return b"".join(ids)

    def _piece(self, piece: str) -> bytes:
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(piece))
        return self._join([w for w, _ in cut], True)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._run(texts)
        if len(self.words) + len(self.plain_words) + len(self.pieces) > self.REMEMBERED:
            for known in (self.words, self.plain_words, self.pieces):
                known.clear()
        out = []
        for t in texts:
            if any(a in t for a in self.added):
                out += self._run([t])
            elif self.PLAIN.fullmatch(t):
                out.append(self._join(self.PLAIN_WORD.findall(t.lower()), False))
            else:
                found = self.PIECE.findall(t)
                ids = list(map(self.pieces.get, found))
                for k in [k for k, x in enumerate(ids) if x is None]:
                    ids[k] = self.pieces[found[k]] = self._piece(found[k])
                out.append(b"".join(ids))
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id",
              text: str = "text", parts: int | None = None, planes: str = "byte",
              block_ids: int = BLOCK_IDS, max_bytes: int = 4_000_000) -> DataFrame:
    """Encode whole texts and write them to ``folder`` in ascending order of ``key``.

    Runs the job. Returns the manifest, one row a file: ``file``, ``n_docs``, ``n_ids``.
    Null keys come first, rows of one key are ordered by their text's hash (and may be
    spread over tasks), a null text counts as empty, an empty table writes no file.
    ``folder`` is a URI or path that every executor can write.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", F.xxhash64("text")]
    src = src.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = WordEncoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        end = np.array([end_id], dtype="<u4").tobytes()
        target, base = _filesystem(folder)
        name = f"ids-{TaskContext.get().partitionId():06d}.tfp"
        temp = f"{base}/.{name}.{uuid.uuid4().hex}"
        sink = writer = None
        for b in small_batches(batches, 1, max_bytes):
            if writer is None:
                target.create_dir(base, recursive=True)
                sink = target.open_output_stream(temp)
                writer = Writer(sink, planes, block_ids)
            encoded = encoder.encode_batch([t or "" for t in b.column(1).to_pylist()])
            for k, ids in zip(b.column(0).to_pylist(), encoded):
                writer.add(k, ids + end)
        if writer is not None:
            writer.close()
            sink.close()
            target.move(temp, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "n_docs": [len(writer.keys)], "n_ids": [sum(writer.lengths)]},
                schema=pa.schema([("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    manifest = python_map(src, run, "file string, n_docs long, n_ids long")
    # A table of one short row a file; written by the same job that writes the files.
    path = f"{folder}/manifest"
    manifest.write.mode("overwrite").parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


def read_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Read the files of :func:`write_ids` back: ``key, start, n_tokens, ids`` a document.

    ``start`` counts the ids of all documents before it, over all files. One task reads
    one file at a time, block by block.
    """
    manifest = spark.read.schema("file string, n_docs long, n_ids long").parquet(f"{folder}/manifest")
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    files = files.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        def flush():
            rec = pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                 pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary())],
                names=[key, "start", "n_tokens", "ids"])
            for r in rows:
                r.clear()
            return rec

        rows: list[list] = [[], [], [], []]
        for b in batches:
            for name, offset in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                source, base = _filesystem(folder)
                with source.open_input_file(f"{base}/{name}") as f:
                    held = 0
                    for k, start, ids in Reader(f).documents():
                        for r, v in zip(rows, (k, offset + start, len(ids) // 4, ids)):
                            r.append(v)
                        held += len(ids)
                        if held > 4_000_000:
                            yield flush()
                            held = 0
                if rows[0]:
                    yield flush()

    return python_map(files, run, schema)
