"""Near-duplicate vectors by sorted projection passes.

1. Vectors with equal components are one node with a weight, so exact copies never meet pairwise.
2. A pass hashes every node by the signs of random projections, concatenated to one number, and sorts
   all nodes by it: vectors of small angle share a long prefix and lie close together. Each node is compared
   with the ``window`` nodes before it (cosine in double precision). All passes, with projections of their
   own, go through one range-sorted exchange.
3. Links found by any pass are united by connected components. Tasks return only links that join what
   they have not joined yet.
4. Windows are bounded, so in a dense region they do not see every pair, also where the region as a whole is below
   the threshold. Nodes that agree in the first :func:`n_signs` signs of a pass are a bucket; a bucket of more than
   ``window`` nodes that are not one component yet is compared in full, in blocks, and the components are united again.
5. The links of a node are counted inside its component: all pairs there are compared in blocks of two times
   ``block`` nodes a task, which return one count a node, never pairs.

The number of passes follows the number of vectors: passes are added until the chance that two vectors at the
threshold's angle share a bucket in none of them is below ``miss``. All pairs of a bucket are compared, by the
window or in full, so that chance does not depend on how the vectors are spread.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import python_map, stored
from tickforge.llm.components import connected_components

BITS = 62


def n_signs(rows: int, window: int) -> int:
    """Signs that make a bucket: of evenly spread vectors it holds at most half a window."""
    return min(BITS, max(1, math.ceil(math.log2(max(2, rows) / window) + 1)))


def n_passes(rows: int, window: int, threshold: float, miss: float) -> int:
    """Passes until a pair at the threshold shares no bucket with a chance below ``miss``."""
    agree = 1 - math.acos(threshold) / math.pi  # chance that one sign agrees
    together = agree ** n_signs(rows, window)
    return max(2, math.ceil(math.log(miss) / math.log1p(-together)))


def _unit(raw: list[bytes]) -> np.ndarray:
    """Rows of unit length in double precision from packed 64-bit components of one size."""
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, dim, raw, d1, d2``: components as bytes and their digest; null where a vector links with nothing."""
    src = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches):
        import xxhash

        for b in batches:
            dim, raw, d1, d2 = [], [], [], []
            for v in b.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v], dtype="<f8") if v else np.zeros(0)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    dim.append(None), raw.append(None), d1.append(None), d2.append(None)
                    continue
                data = (x + 0.0).tobytes()  # -0.0 equals 0.0
                a, c = np.frombuffer(xxhash.xxh3_128_digest(data), dtype="<i8").tolist()
                dim.append(len(x)), raw.append(data), d1.append(a), d2.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(dim, pa.int32()), pa.array(raw, pa.binary()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=["key", "dim", "raw", "d1", "d2"])

    return python_map(src, run, "key long, dim int, raw binary, d1 long, d2 long")


def _planes(dim: int, passes: int, seed: int) -> np.ndarray:
    """The random projections (dim, passes, BITS) of vectors of one size."""
    return np.random.default_rng([seed, dim]).normal(size=(dim, passes * BITS)).reshape(dim, passes, BITS)


_PASS_ROWS = "u long, v long, border int, side int, dim int, pass int, node long, raw binary"


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _sorted_passes(nodes: DataFrame, rows: int, passes: int, window: int, threshold: float, seed: int) -> DataFrame:
    """Links (u, v) between neighbours of the sorted passes; ``nodes``: node, dim, raw.

    A window that crosses the border of two partitions is compared afterwards, from the last and
    first ``window`` rows that every partition hands on. (A partition holds many windows.)
    """

    def hashed(batches):
        planes: dict[int, np.ndarray] = {}
        power = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for b in batches:
            names, dims, raws = (b.column(k).to_pylist() for k in range(3))
            for dim in sorted(set(dims)):
                if dim not in planes:
                    planes[dim] = _planes(dim, passes, seed).reshape(dim, -1)
                at = [i for i, d in enumerate(dims) if d == dim]
                signs = (_unit([raws[i] for i in at]) @ planes[dim] > 0).reshape(len(at), passes, BITS)
                keys = signs @ power
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), dim), pa.int32()), pa.array(np.full(len(at), p), pa.int32()),
                         pa.array(keys[:, p], pa.int64()), pa.array([names[i] for i in at], pa.int64()),
                         pa.array([raws[i] for i in at], pa.binary())], names=["dim", "pass", "hash", "node", "raw"])

    keyed = python_map(nodes, hashed, "dim int, pass int, hash long, node long, raw binary")
    order = ["dim", "pass", "hash", "node"]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, rows * passes // (16 * window)))
    keyed = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def compare(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first: list[tuple] = []
        last: list[tuple] = []
        run, names, tail = None, [], None  # the last nodes of the run (one dim and pass) and their vectors
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for b in batches:
            dims, ps, nodes_, raws = (b.column(k).to_pylist() for k in (0, 1, 3, 4))
            ends = list(zip(dims, ps, nodes_, raws))
            first += ends[:window - len(first)]
            last = (last + ends)[-window:]
            i, out = 0, []
            while i < len(dims):
                j = i + 1
                while j < len(dims) and j - i < 512 and (dims[j], ps[j]) == (dims[i], ps[i]):
                    j += 1
                if (dims[i], ps[i]) != run:
                    run, names, tail = (dims[i], ps[i]), [], np.zeros((0, dims[i]))
                now = _unit(raws[i:j])
                x, ids = np.concatenate([tail, now]), names + nodes_[i:j]
                t = len(names)
                near = now @ x.T >= threshold
                gap = (np.arange(len(now)) + t)[:, None] - np.arange(len(x))
                for r, c in np.argwhere(near & (gap > 0) & (gap <= window)).tolist():
                    u, v = find(ids[t + r]), find(ids[c])
                    if u != v:
                        root[max(u, v)] = min(u, v)
                        out.append((ids[t + r], ids[c]))
                names, tail = ids[-window:], x[-window:]
                i = j
            if out:
                u, v = zip(*out)
                none = [None] * len(out)
                yield _row_batch(u, v, none, none, none, none, none, none)
        ends = [(part - 1, 1, *r) for r in first] + [(part, 0, *r) for r in last]
        if ends:
            none = [None] * len(ends)
            yield _row_batch(none, none, *zip(*ends))

    found = stored(python_map(keyed, compare, _PASS_ROWS), "vec-passes")

    def across(batches):
        border, held = None, []

        def links():
            out, root = [], {}

            def find(x):
                while root.setdefault(x, x) != x:
                    x = root[x]
                return x

            for run in sorted({r[1:3] for r in held}):
                a, b = ([r for r in held if r[1:3] == run and r[0] == side] for side in (0, 1))
                if a and b:
                    near = _unit([r[4] for r in a]) @ _unit([r[4] for r in b]).T >= threshold
                    for x, y in np.argwhere(near).tolist():
                        u, v = find(a[x][3]), find(b[y][3])
                        if u != v:  # only what joins something new
                            root[max(u, v)] = min(u, v)
                            out.append((a[x][3], b[y][3]))
            return out

        for b in batches:
            for k, *r in zip(*(b.column(c).to_pylist() for c in range(6))):
                if k != border:
                    if held and (out := links()):
                        yield _links(out)
                    border, held = k, []
                held.append(tuple(r))
        if held and (out := links()):
            yield _links(out)

    borders = (found.filter("border is not null").select("border", "side", "dim", "pass", "node", "raw")
               .repartition("border").sortWithinPartitions("border"))
    return found.filter("u is not null").select("u", "v").union(python_map(borders, across, "u long, v long"))


def _row_batch(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _PASS_ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _buckets(nodes: DataFrame, passes: int, signs: int, seed: int) -> DataFrame:
    """``dim, pass, bucket, node, c`` of every node and pass; ``nodes``: node, dim, raw, c."""

    def hashed(batches):
        planes: dict[int, np.ndarray] = {}
        power = 1 << np.arange(signs - 1, -1, -1, dtype=np.int64)
        for b in batches:
            names, dims, raws, comps = (b.column(k).to_pylist() for k in range(4))
            for dim in sorted(set(dims)):
                if dim not in planes:
                    planes[dim] = np.ascontiguousarray(_planes(dim, passes, seed)[:, :, :signs]).reshape(dim, -1)
                at = [i for i, d in enumerate(dims) if d == dim]
                bucket = (_unit([raws[i] for i in at]) @ planes[dim] > 0).reshape(len(at), passes, signs) @ power
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(bucket.size, dim), pa.int32()), pa.array(np.tile(np.arange(passes), len(at)), pa.int32()),
                     pa.array(bucket.reshape(-1), pa.int64()),
                     pa.array(np.repeat(np.array([names[i] for i in at], dtype=np.int64), passes)),
                     pa.array(np.repeat(np.array([comps[i] for i in at], dtype=np.int64), passes))],
                    names=["dim", "pass", "bucket", "node", "c"])

    return python_map(nodes, hashed, "dim int, pass int, bucket long, node long, c long")


def _dense_links(nodes: DataFrame, comp: DataFrame, passes: int, signs: int, window: int, threshold: float,
                 block: int, seed: int) -> DataFrame | None:
    """Links (u, v) between components that meet in a bucket wider than the window; none: no such bucket.

    The buckets are compared one by one, or all their nodes with one another if that makes fewer pairs (as the
    buckets of a very dense region are about the same in all passes).
    """
    own = nodes.join(comp, nodes["node"] == comp["node"], "left").select(
        nodes["node"], "dim", "raw", F.coalesce("component", nodes["node"]).alias("c"))
    dealt = _buckets(own, passes, signs, seed)
    wide = (dealt.groupBy("dim", "pass", "bucket").agg(F.count("*").alias("n"), F.min("c").alias("a"), F.max("c").alias("z"))
            .filter(f"n > {int(window)} and a < z"))
    wide = stored(wide.select(F.col("dim").alias("wd"), F.col("pass").alias("wp"), F.col("bucket").alias("wb"), "n"), "vec-wide")
    apart = wide.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0]
    if apart is None:
        return None
    inside = stored(dealt.join(wide, (F.col("dim") == F.col("wd")) & (F.col("pass") == F.col("wp"))
                               & (F.col("bucket") == F.col("wb"))).select("dim", "pass", "bucket", "node"), "vec-dense")
    nodes_of = inside.select("dim", "node").distinct()
    whole = nodes_of.groupBy("dim").count().agg(F.sum(F.col("count").cast("double") * F.col("count"))).first()[0]
    if whole <= apart:
        member = nodes_of.select(F.col("node").alias("m"), F.col("dim").cast("string").alias("g"))
    else:
        member = inside.select(F.col("node").alias("m"), F.concat_ws(":", "dim", "pass", "bucket").alias("g"))
    units = _units(own.select("node", F.col("c").alias("extra"), "raw"), member, block)

    def joined(held):
        """A spanning forest of the links of a unit, without what joins one component to itself."""
        names, comps, raws, _ = zip(*held)
        x, c = _unit(list(raws)), np.array(comps)
        near = x @ x.T >= threshold
        left, out = np.ones(len(x), dtype=bool), []
        for start in range(len(x)):
            if not left[start]:
                continue
            left[start] = False
            todo = [start]
            while todo:
                k = todo.pop()
                new = np.flatnonzero(near[k] & left)
                left[new] = False
                todo += new.tolist()
                out += [(names[k], names[i]) for i in new[c[new] != c[k]].tolist()]
        return out

    def compare(batches):
        unit, held = None, []
        for b in batches:
            for name, extra, raw, side, *at in zip(*(b.column(k).to_pylist() for k in range(7))):
                if at != unit:
                    if len(held) > 1 and (out := joined(held)):
                        yield _links(out)
                    unit, held = at, []
                held.append((name, extra, raw, side))
        if len(held) > 1 and (out := joined(held)):
            yield _links(out)

    return python_map(units, compare, "u long, v long")


def _units(nodes: DataFrame, member: DataFrame, block: int) -> DataFrame:
    """``node, extra, raw, b, g, i, j``: the nodes of every two blocks (i, j) of a group, side by side.

    ``nodes``: node, extra, raw; ``member``: m (a node), g (its group; a node may be in many).
    """
    size = member.groupBy(F.col("g").alias("sg")).agg(F.count("*").alias("members"))
    dealt = (member.join(size, F.col("g") == F.col("sg"))
             .withColumn("nb", F.ceil(F.col("members") / block).cast("int"))
             .withColumn("b", F.pmod(F.xxhash64("m", F.lit(17)), F.col("nb")).cast("int"))
             .select("m", "g", "nb", "b"))
    rows = nodes.join(dealt.hint("merge"), F.col("node") == F.col("m"))
    rows = rows.select("node", "extra", "raw", "g", "b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
    units = rows.select("node", "extra", "raw", "b", "g", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))
    return units.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "node")


def _counts(nodes: DataFrame, comp: DataFrame, threshold: float, block: int) -> DataFrame:
    """``node, links``: weights of all nodes of the same component at or above the threshold, without itself."""
    units = _units(nodes.select("node", F.col("weight").alias("extra"), "raw"),
                   comp.select(F.col("node").alias("m"), F.col("component").alias("g")), block)

    def compare(batches):
        unit, held = None, []

        def count():
            names, weights, raws, sides = zip(*held)
            sides, w = np.array(sides), np.array(weights, dtype=np.float64)
            x = _unit(list(raws))
            if unit[1] == unit[2]:
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
            else:
                near = (x @ x.T >= threshold) & (sides[:, None] != sides[None, :])
            return names, (near @ w).astype(np.int64)

        def flush():
            names, n = count()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(n, pa.int64())], names=["node", "links"])

        for b in batches:
            for name, weight, raw, side, g, i, j in zip(*(b.column(k).to_pylist() for k in range(7))):
                if (g, i, j) != unit:
                    if len(held) > 1:
                        yield flush()
                    unit, held = (g, i, j), []
                held.append((name, weight, raw, side))
        if len(held) > 1:
            yield flush()

    return python_map(units, compare, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    window: int = 128, miss: float = 0.002, block: int = 256, seed: int = 13) -> DataFrame:
    """One row a vector: ``key, n_links, component_id, kept``.

    Linked are vectors of one length with cosine >= ``threshold``. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. ``component_id`` is the smallest key
    reachable, ``kept`` marks the row of that key. A null key gives a null component, no links and is
    kept. Keys are expected to be unique; rows that repeat a key with another vector are taken as one node with
    the links of both. An empty table gives an empty result.
    """
    base = stored(_prepared(vectors, key, vector), "vec-base")
    named = base.filter("key is not null and d1 is not null")
    nodes = stored(named.groupBy("d1", "d2").agg(F.min("key").alias("node"), F.count("*").alias("weight"),
                                                 F.first("dim").alias("dim"), F.first("raw").alias("raw")), "vec-nodes")
    rows = nodes.count()
    passes = n_passes(rows, window, threshold, miss)
    links = _sorted_passes(nodes.select("node", "dim", "raw"), rows, passes, window, threshold, seed)
    comp = stored(connected_components(links), "vec-components")
    dense = _dense_links(nodes.select("node", "dim", "raw"), comp, passes, n_signs(rows, window), window, threshold,
                         4 * block, seed)
    if dense is not None:
        known = comp.select(F.col("node").alias("u"), F.col("component").alias("v"))
        comp = stored(connected_components(known.union(dense)), "vec-components")
    counts = _counts(nodes.select("node", "weight", "raw"), comp, threshold, block)
    of_node = (nodes.select("d1", "d2", "node", "weight")
               .join(comp.withColumnRenamed("node", "cn"), F.col("node") == F.col("cn"), "left")
               .join(counts.withColumnRenamed("node", "ln"), F.col("node") == F.col("ln"), "left")
               .select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "node").alias("c"),
                       (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n")))
    out = base.select("key", "d1", "d2").join(
        of_node, F.col("key").isNotNull() & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("c", "key"))
    return out.select(F.col("key").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))
