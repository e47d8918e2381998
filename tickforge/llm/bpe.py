"""Byte-pair encoding by speculation and verification, and decoding.

Encoding a distinct word (pre-token):

1. *Speculate*: greedy longest match cuts the word into vocabulary tokens.
2. *Verify*: a cut is the true BPE result exactly when every token is what BPE
   makes of its own bytes and every two neighbours are compatible: replaying the
   merges of both from the last to the first, no merge across their border comes
   due before the merges that close it off. All adjacent pairs of a batch are
   checked together on numpy arrays.
3. Only words with a failing pair go through exact merging.

Words are encoded once per batch and task, and remembered up to a bound; texts are
joined from the encoded words. The tokenizer file is a parameter, read
by each Python worker; it must be at the same path on all of them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickforge.llm.common import python_map

#: Fixed by the file format: where GPT-2 style byte-level vocabularies keep each byte.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: A single white-space character between two others of no white space always
#: separates pre-tokens, so texts may be cut before it.
_SAFE_CUT = re.compile(r" (?<=\S )(?=\S)")

#: The same word pattern for ASCII text, where it needs no Unicode classes.
_ASCII_WORDS = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                          r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

SHORT = 64  # words up to this many bytes are merged together, longer ones one by one

REMEMBERED = 600_000  # distinct pieces kept between batches (a memory bound, not a cap on input)


def byte_chars() -> list[str]:
    """The character that stands for each byte 0..255 in the vocabulary."""
    chars, extra = {}, 256
    for b in _PRINTABLE:
        chars[b] = chr(b)
    for b in range(256):
        if b not in chars:
            chars[b] = chr(extra)
            extra += 1
    return [chars[b] for b in range(256)]


class SpeculativeBpe:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        self.cutter = Tokenizer.from_file(path).pre_tokenizer  # the file's own word pattern
        self.vocab: dict[str, int] = model["vocab"]
        self.reach: dict[str, int] = {}  # longest token by its first two characters
        for t in self.vocab:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_re = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        size = max([*self.vocab.values(), *self.added.values()]) + 1

        # The merge that makes each token: its rank and its two parts (base tokens: none).
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([self.vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int64)
        self.rank_of = np.full(size, -1, dtype=np.int64)
        self.part_l, self.part_r = np.arange(size), np.arange(size)
        for rank in range(len(merges) - 1, -1, -1):  # the first merge that makes a token counts
            t = made[rank]
            self.rank_of[t], self.part_l[t], self.part_r[t] = rank, left[rank], right[rank]
        self.n_ids, self.made = size, made
        self.one_merge_each = len(np.unique(made)) == len(made)
        order = np.argsort(left * size + right)
        self.pair_keys = (left * size + right)[order]
        self.pair_ranks = order.astype(np.int64)
        self.merge_to = {(a, b): (r, m) for r, (a, b, m) in
                         enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}

        # Tokens that BPE really produces: bytes, and tokens whose halves stay apart
        # until the merge that joins them.
        self.sound = np.zeros(size, dtype=bool)
        base = self.rank_of < 0
        base[list(self.added.values())] = False
        self.sound[base] = True
        joined = np.flatnonzero(self.rank_of >= 0)
        ok = self._apart(self.part_l[joined], self.part_r[joined], self.rank_of[joined])
        own = np.zeros(size, dtype=bool)
        own[joined] = ok
        for t in joined[np.argsort(self.rank_of[joined])].tolist():  # parts come first
            self.sound[t] = own[t] and self.sound[self.part_l[t]] and self.sound[self.part_r[t]]

        to_byte = {c: b for b, c in enumerate(byte_chars())}
        self.bytes_of: list[bytes] = [b""] * size
        for s, i in self.vocab.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in s)
        for s, i in self.added.items():
            self.bytes_of[i] = s.encode("utf-8")
        self.shown = {b: c for b, c in enumerate(byte_chars()[:128]) if chr(b) != c}
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b; a large number if there is none."""
        keys = a * self.n_ids + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.iinfo(np.int64).max)

    def _apart(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Do BPE merges leave tokens a and b apart (until the merge ``below``)?

        Goes back in time: of the two tokens at the border, the one made last is
        replaced by its part at the border. While both stood side by side, a merge
        across the border was due before the undone one if its rank is lower, or is
        equal and the undone merge lies further right (equal ranks go left to right).
        """
        n = len(a)
        a, b = a.copy(), b.copy()
        # Merges of this rank or later cannot have come first.
        limit = np.full(n, np.iinfo(np.int64).max) if below is None else below.copy()
        ok = np.ones(n, dtype=bool)
        live = np.arange(n)
        while live.size:
            x, y = a[live], b[live]
            clash = self._ranks(x, y) < limit[live]
            ok[live[clash]] = False
            rx, ry = self.rank_of[x], self.rank_of[y]
            go = ~clash & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry  # equal ranks: the left one was made first
            a[live[undo_left]] = self.part_r[x[undo_left]]
            b[live[~undo_left]] = self.part_l[y[~undo_left]]
            limit[live] = np.where(undo_left, rx, ry + 1)
        return ok

    def _propose(self, word: str) -> list[int]:
        vocab, reach, out, i, n = self.vocab, self.reach, [], 0, len(word)
        while i < n:
            j = min(n, i + reach.get(word[i:i + 2], 1))
            while j > i:
                t = vocab.get(word[i:j])
                if t is not None:
                    out.append(t)
                    break
                j -= 1
            else:
                raise ValueError(f"byte {word[i]!r} is not in the vocabulary")
            i = j
        return out

    def merge_exactly(self, word: str) -> list[int]:
        """Plain BPE: always the lowest rank, leftmost first; O(n log n)."""
        ids = [self.vocab[c] for c in word]
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []
        for i in range(n - 1):
            m = self.merge_to.get((ids[i], ids[i + 1]))
            if m:
                heap.append((m[0], i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or ids[i] != x or ids[j] != y:
                continue  # one of the two has changed since
            ids[i] = self.merge_to[(x, y)][1]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                m = self.merge_to.get((ids[i], ids[nxt[i]]))
                if m:
                    heapq.heappush(heap, (m[0], i, ids[i], ids[nxt[i]]))
            if prv[i] >= 0:
                m = self.merge_to.get((ids[prv[i]], ids[i]))
                if m:
                    heapq.heappush(heap, (m[0], prv[i], ids[prv[i]], ids[i]))
        return [t for t, a in zip(ids, alive) if a]

    def merge_together(self, words: list[str]) -> list[list[int]]:
        """Plain BPE for many short words at once.

        Each round merges, in every word, all pairs of the word's lowest rank, left to
        right. That equals one merge at a time because every token has one merge that
        makes it, so pairs with the new token have higher ranks.
        """
        if not words:
            return []
        vocab = self.vocab
        ids = np.array([vocab[c] for w in words for c in w], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        out: list[list[int]] = [[] for _ in words]
        while ids.size:
            same = owner[1:] == owner[:-1]
            rank = np.full(len(ids), np.iinfo(np.int64).max)
            rank[:-1][same] = self._ranks(ids[:-1][same], ids[1:][same])
            starts = np.flatnonzero(np.r_[True, ~same])
            low = np.minimum.reduceat(rank, starts)
            done = low == np.iinfo(np.int64).max
            if done.any():
                ends = np.r_[starts[1:], len(ids)]
                for w in np.flatnonzero(done).tolist():
                    out[owner[starts[w]]] = ids[starts[w]:ends[w]].tolist()
            lows = np.repeat(low, np.diff(np.r_[starts, len(ids)]))
            live = lows < np.iinfo(np.int64).max
            hit = live & (rank == lows)
            # In a run of overlapping pairs (a a a) every second one is merged.
            first = hit & ~np.r_[False, hit[:-1]]
            run = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
            hit &= run % 2 == 0
            ids = ids.copy()
            ids[hit] = self.made[rank[hit]]
            keep = live & ~np.r_[False, hit[:-1]]
            ids, owner = ids[keep], owner[keep]
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word (in the vocabulary's byte characters)."""
        if not words:
            return []
        cuts = [self._propose(w) for w in words]
        flat = np.array([t for c in cuts for t in c], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), [len(c) for c in cuts])
        wrong = np.zeros(len(words), dtype=bool)
        wrong[owner[~self.sound[flat]]] = True
        side = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[side] * self.n_ids + flat[side + 1], return_inverse=True)
        apart = self._apart(pairs // self.n_ids, pairs % self.n_ids)
        wrong[owner[side[~apart[back]]]] = True
        failing = np.flatnonzero(wrong).tolist()
        short = [k for k in failing if len(words[k]) <= SHORT and self.one_merge_each]
        for k, ids in zip(short, self.merge_together([words[k] for k in short])):
            cuts[k] = ids
        for k in set(failing).difference(short):
            cuts[k] = self.merge_exactly(words[k])
        return cuts

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet; a piece may hold several pre-tokens."""
        cut = [[w.translate(self.shown) for w in _ASCII_WORDS.findall(p)] if p.isascii()
               else [w for w, _ in self.cutter.pre_tokenize_str(p)] for p in pieces]
        packed = self.known_words
        words = list({w for c in cut for w in c if w not in packed})
        ids = self.encode_words(words)
        flat = np.fromiter((t for c in ids for t in c), dtype="<u4").tobytes()
        at = 0
        for w, c in zip(words, ids):
            packed[w] = flat[at:at + 4 * len(c)]
            at += 4 * len(c)
        for p, c in zip(pieces, cut):
            self.known[p] = packed[c[0]] if len(c) == 1 else b"".join([packed[w] for w in c])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) + len(self.known_words) > REMEMBERED:
            self.known.clear()
            self.known_words.clear()
        parts: list[list[str]] = []
        for text in texts:
            found: list[str] = []
            at = 0
            for m in self.added_re.finditer(text) if self.added_re else ():
                found += self._pieces(text[at:m.start()])
                found.append(m[0])
                at = m.end()
            found += self._pieces(text[at:] if at else text)
            parts.append(found)
        for s, i in self.added.items():
            self.known[s] = np.array([i], dtype="<u4").tobytes()
        fresh = {p for ps in parts for p in ps if p not in self.known}
        self._learn(list(fresh))
        known = self.known
        return [b"".join([known[p] for p in ps]) for ps in parts]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        if not text:
            return []
        first, *rest = _SAFE_CUT.split(text)
        return [first, *[" " + p for p in rest]]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]
                        ).decode("utf-8", "replace")


_LOADED: dict[str, SpeculativeBpe] = {}


def loaded(path: str) -> SpeculativeBpe:
    """One encoder per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = SpeculativeBpe(path)
    return _LOADED[path]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a column holds about ``max_bytes`` in each."""
    for b in batches:
        if not b.num_rows:
            continue
        n = max(1, int(b.num_rows * min(1.0, max_bytes / max(1, b.column(column).nbytes))))
        for i in range(0, b.num_rows, n):
            yield b.slice(i, n)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids",
           max_bytes: int = 4_000_000) -> DataFrame:
    """Add the packed token ids of every whole text (a null text counts as empty).

    The ids are one binary value a row, little-endian unsigned 32-bit integers. All
    columns pass through; a column that is called ``ids`` already is replaced. Nothing is shuffled, repeated
    rows give repeated results, an empty table an empty one.
    """
    from pyspark.sql import types as T

    docs = docs.drop(ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType())])
    at = docs.columns.index(text)

    def run(batches):
        bpe = loaded(tokenizer)
        for b in small_batches(batches, at, max_bytes):
            out = bpe.encode_batch([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=[*b.schema.names, ids])

    return python_map(docs, run, schema)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text",
           max_bytes: int = 4_000_000) -> DataFrame:
    """Replace (or add) ``text`` by what the packed ``ids`` decode to; null ids give null."""
    from pyspark.sql import types as T

    keep = [c for c in encoded.columns if c != text]
    src = encoded.select(*keep)
    schema = T.StructType([*src.schema.fields, T.StructField(text, T.StringType())])
    at = keep.index(ids)

    def run(batches):
        bpe = loaded(tokenizer)
        for b in small_batches(batches, at, max_bytes):
            out = [None if x is None else bpe.decode(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())],
                                             names=[*b.schema.names, text])

    return python_map(src, run, schema)


def digest(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           max_bytes: int = 4_000_000) -> DataFrame:
    """Encode, decode and digest in one pass: key, n_tokens, ids_sha256, decoded_sha256."""
    from pyspark.sql import types as T

    src = docs.select(key, text)
    schema = T.StructType([src.schema.fields[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        bpe = loaded(tokenizer)
        for b in small_batches(batches, 1, max_bytes):
            ids = bpe.encode_batch([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(bpe.decode(x).encode("utf-8")).hexdigest() for x in ids])],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return python_map(src, run, schema)
