"""Near-duplicate documents by MinHash, banding, verification and components.

1. *Sketch*: every document becomes its set of shingle hashes (64 bits), the digest of
   that set, and ``bands`` keys, each over ``rows`` minima of universal hash functions.
2. Documents of equal digest are one node, so exact copies never meet pairwise.
3. Nodes that share a band key are candidates: every node of a bucket is linked to the
   bucket's smallest node, and the components of these links are *candidate groups*.
   Two similar sets share a key but for a chance of about 4 in 10 million at a similarity of 0.85, and of
   about 5 in 100,000 at 0.80 (25 bands of 5).
4. *Verify*: inside a candidate group all pairs are compared on the full sets. A group is
   cut into blocks of about ``block`` nodes; a task holds two blocks at a time and returns
   only links that join what is not joined yet, at most one a node.
5. Components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bpe import small_batches
from tickforge.llm.common import python_map, stored
from tickforge.llm.components import connected_components

BANDS, ROWS, BLOCK = 25, 5, 128
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word shingles; of the whole text if it is shorter."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # ASCII only, for bytes
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(w))
    h = np.full(len(w) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        h = _mixed(h * _GOLD + w[k:len(w) - width + 1 + k])
    return np.unique(h)


class Hasher:
    """The universal hash functions h -> a * h + b (mod 2**64), a odd."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One key a band."""
        low = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(hashes), 512):  # a slice of the table fits the cache
            np.minimum(low, (hashes[i:i + 512, None] * self.a + self.b).min(axis=0), out=low)
        low = low.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            key = _mixed(key * _GOLD + low[:, k])
        return key.view(np.int64)


def sketch(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """``key, n, d1, d2, keys``: set size, digest of the set (null if empty), band keys."""
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        import xxhash

        hasher = Hasher(bands, rows)
        for b in small_batches(batches, 1, 4_000_000):
            n, d1, d2, keys, seen = [], [], [], [], {}
            for t in b.column(1).to_pylist():
                s = shingle_set(t, width)
                n.append(len(s))
                if not len(s):
                    d1.append(None), d2.append(None), keys.append(None)
                    continue
                raw = xxhash.xxh3_128_digest(s.tobytes())
                if raw not in seen:
                    seen[raw] = hasher.keys(s)
                a, c = np.frombuffer(raw, dtype="<i8").tolist()
                d1.append(a), d2.append(c), keys.append(seen[raw])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["key", "n", "d1", "d2", "keys"])

    return python_map(src, run, "key long, n long, d1 long, d2 long, keys array<long>")


def forest(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs with 100 |A & B| >= percent |A | B|.

    With ``side`` only pairs of different sides are compared. Shingles that occur once
    are left out of the product, which so stays narrow in groups of near copies.
    """
    n, size = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    again = flat[1:] == flat[:-1]
    common = np.r_[again, False] | np.r_[False, again]
    flat, owner = flat[common], owner[common]
    col = np.cumsum(np.r_[True, flat[1:] != flat[:-1]]) - 1 if len(flat) else np.zeros(0, np.int64)
    both = np.zeros((n, n), dtype=np.float32)  # counts below 2**24 are exact
    step = max(64, 8_000_000 // n)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, b = np.searchsorted(col, [lo, lo + step])
        m = np.zeros((n, step), dtype=np.float32)
        m[owner[a:b], col[a:b] - lo] = 1
        both += m @ m.T
    inter = both.astype(np.int64)
    union = size[:, None] + size[None, :] - inter
    link = np.triu(100 * inter >= percent * union, 1)
    if side is not None:
        link &= side[:, None] != side[None, :]
    root, out = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(*map(np.ndarray.tolist, np.nonzero(link))):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def verified_links(docs: DataFrame, groups: DataFrame, key: str, text: str, width: int,
                   percent: int, block: int) -> DataFrame:
    """Confirmed links (u, v) inside candidate groups; ``groups``: node, component."""
    size = groups.groupBy(F.col("component").alias("g")).agg(F.count("*").alias("members"))
    member = (groups.join(size, F.col("component") == F.col("g"))
              .select("node", "g", F.ceil(F.col("members") / block).cast("int").alias("nb"))
              .withColumn("b", F.pmod(F.xxhash64("node", F.lit(99)), F.col("nb")).cast("int")))
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # Texts are joined by shuffling at every size: the groups are too many to be sent to all tasks.
    src = (src.join(member.hint("merge"), F.col("key") == F.col("node")).drop("node")
           .select("key", "g", "nb", "b", "text"))

    def sets(batches):
        for b in small_batches(batches, 4, 4_000_000):
            found = [shingle_set(t, width).tobytes() for t in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(found, pa.binary())],
                                             names=["key", "g", "nb", "b", "hashes"])

    have = python_map(src, sets, "key long, g long, nb int, b int, hashes binary")
    # Block i meets block j in task (i, j), i <= j; a group of one block is one unit.
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")
    units = (have.select("key", "g", "b", "hashes", other)
             .select("key", "b", "hashes", "g", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j")))
    units = units.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "key")

    def compare(batches):
        held: dict = {"unit": None, "keys": [], "sides": [], "sets": []}

        def links():
            keys, sides = held["keys"], np.array(held["sides"])
            _, i, j = held["unit"]
            got = forest(held["sets"], percent, sides if i != j else None) if len(keys) > 1 else []
            return [(keys[x], keys[y]) for x, y in got]

        for b in batches:
            out = []
            cols = [b.column(k).to_pylist() for k in range(6)]
            for key_, side, raw, g, i, j in zip(*cols):
                if (g, i, j) != held["unit"]:
                    if held["unit"] is not None:
                        out += links()
                    held.update(unit=(g, i, j), keys=[], sides=[], sets=[])
                if held["keys"] and held["keys"][-1] == key_:
                    continue  # a repeated row
                held["keys"].append(key_)
                held["sides"].append(side)
                held["sets"].append(np.frombuffer(raw, dtype=np.uint64))
            if out:
                yield _links(out)
        if held["unit"] is not None and (out := links()):
            yield _links(out)

    return python_map(units, compare, "u long, v long")


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    block: int = BLOCK) -> DataFrame:
    """One row a document: ``key, n_shingles, component_id, kept``.

    Similar means 100 * intersection >= ``percent`` * union on the sets of ``width``-word
    shingles of the whole text (A-Z lower-cased). ``component_id`` is the smallest key
    reachable over links, ``kept`` marks the row whose key it is. A text without words, or a
    null text, has an empty set and links with nothing; a null key gives a null component
    and is kept. Keys are expected to be unique; rows that repeat a key share its component
    and are linked by whichever text the smallest node of their set has. Only key and text
    are read, so other columns cannot clash; an empty table gives an empty result.
    """
    base = stored(sketch(docs, key, text, width, bands, rows), "minhash")
    named = base.filter("key is not null and d1 is not null")
    nodes = named.groupBy("d1", "d2").agg(F.min("key").alias("node"), F.min_by("keys", "key").alias("keys"))
    nodes = stored(nodes, "minhash-nodes")
    entries = nodes.select("node", F.explode("keys").alias("bucket"))
    hubs = (entries.groupBy(F.col("bucket").alias("hb"))
            .agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub != top").drop("top"))
    stars = (entries.join(hubs, F.col("bucket") == F.col("hb")).filter("node != hub")
             .select(F.col("node").alias("u"), F.col("hub").alias("v")))
    groups = stored(connected_components(stars), "minhash-groups")
    links = verified_links(docs, groups, key, text, width, percent, block)
    comp = connected_components(links)
    of_node = (nodes.select("d1", "d2", "node")
               .join(comp.withColumnRenamed("node", "cn"), F.col("node") == F.col("cn"), "left")
               .select(F.col("d1").alias("e1"), F.col("d2").alias("e2"),
                       F.coalesce("component", "node").alias("c")))
    out = base.select("key", "n", "d1", "d2").join(
        of_node, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("c", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))
