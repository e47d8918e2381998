"""Merkle manifest of a data set, with a persistent tree of versions.

The rows of a group (``tree``, for instance a language) are the leaves of a binary hash tree in the order of a key;
the groups' roots are the leaves of a tree of their own, whose root stands for the whole table.

1. Leaves are hashed and ranked inside their group by one range sort.
2. A task holds aligned blocks of ``2 ** height`` leaves. The roots of the blocks are the leaves of the next round, which is
   cut into blocks in the same way, until every group has one node. So no task holds more than one block
   at a time, whatever a group's size; the rounds grow with the logarithm of the largest group.
3. Going down again, every block gets one short row: the siblings of its root up to the root of the table.
4. A changed leaf is a version of its own. It shares every node with the manifest but its ancestors: inside the block
   they are copied along one path, and above it the version goes on with the block's siblings, in the same task, so
   versions are spread as their leaves are, also where one upper block lies above millions of versions.

A node is H of its one or two children; H is the lowercase hex SHA-256 of its inputs, digests as hex text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import ROW, packed, python_map, stored, unpacked
from tickforge.llm.ranks import ranked

#: Aligned blocks of 1024 leaves.
HEIGHT = 10


def encoded(values: list[Column]) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text, one after the other."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def node(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Block:
    """The tree over the leaves of one aligned block; versions copy one path and share the rest.

    ``levels`` is the number of steps to its root. A block that is cut short by the end of its group still
    takes all of them (a node alone becomes its H), so that its root lies at the level of the other blocks' roots.
    """

    def __init__(self, leaves: list[str], levels: int):
        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([node(*below[i:i + 2]) for i in range(0, len(below), 2)])
        self.root = self.levels[-1][0]

    def siblings(self, pos: int) -> tuple[list[str], str]:
        """Siblings on the way up and, a letter a step, where they are: Left, Right, or none (``-``)."""
        found, sides = [], []
        for level in self.levels[:-1]:
            if pos ^ 1 < len(level):
                found.append(level[pos ^ 1])
                sides.append("L" if pos & 1 else "R")
            else:
                sides.append("-")
            pos >>= 1
        return found, "".join(sides)


def climb(leaf: str, siblings: list[str], sides: str) -> list[str]:
    """The ancestors of a leaf, from its parent up to the root: the nodes that a version copies."""
    out, at = [], iter(siblings)
    for side in sides:
        leaf = node(leaf) if side == "-" else node(next(at), leaf) if side == "L" else node(leaf, next(at))
        out.append(leaf)
    return out


def _steps(total: int, height: int) -> int:
    """Levels of a block: all of them, or those that a group needs that fits into one block."""
    return min(height, (total - 1).bit_length())


def _blocks(batches, names: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the columns ``names`` (sorted together), one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        keys = list(zip(*(b.column(n).to_pylist() for n in names)))
        start = 0
        for i, k in enumerate(keys):
            if k != last:
                if i > start:
                    held.append(b.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, k
        if start < len(keys):
            held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Every block's rows together and in order, one block after the other."""
    nodes = nodes.withColumn("block", F.coalesce(F.shiftright("pos", height), F.col("block")) if "block" in nodes.columns
                             else F.shiftright("pos", height))
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("pos").asc_nulls_first())


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """``tree, pos, total, digest`` of the next round."""

    def run(batches):
        for t in _blocks(batches, ["tree", "block"]):
            total = t["total"][0].as_py()
            root = Block(t["digest"].to_pylist(), _steps(total, height)).root
            yield pa.RecordBatch.from_arrays(
                [t["tree"].slice(0, 1).combine_chunks(), t["block"].slice(0, 1).combine_chunks(),
                 pa.array([-(-total // (1 << height))], pa.int64()), pa.array([root])], names=["tree", "pos", "total", "digest"])

    rows = _in_blocks(nodes.select("tree", "pos", "total", "digest"), height)
    return python_map(rows.select("tree", "block", "total", "digest"), run, "tree string, pos long, total long, digest string")


def _rounds(leaves: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round (the first are the leaves), and ``tree, round, digest`` of every tree's root."""
    largest = leaves.agg(F.max("total")).first()[0] or 1
    levels, roots, k = [leaves], None, 0
    while True:
        up = stored(_block_roots(levels[-1], height), f"merkle-round{k}")
        done = up.filter("total = 1").select("tree", F.lit(k).alias("round"), "digest")
        roots = done if roots is None else roots.union(done)
        largest = -(-largest // (1 << height))
        if largest <= 1:
            return levels, roots
        levels.append(up.filter("total > 1"))
        k += 1


#: What stands above a node: its siblings up to the table's root (hex digests) and their sides, the roots of its tree and of the table.
_ABOVE = "siblings array<string>, sides string, subroot string, root string"


def _descend(nodes: DataFrame, heads: DataFrame, height: int) -> DataFrame:
    """``tree, pos`` and what stands above, of all nodes of a round; ``heads``: the same of its blocks (``pos``: the block)."""

    def run(batches):
        for t in _blocks(batches, ["tree", "block"]):
            head, rows = t.slice(0, 1).to_pylist()[0], t.slice(1)
            block = Block(rows["digest"].to_pylist(), _steps(rows["total"][0].as_py(), height))
            own = [block.siblings(i) for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays(
                [rows["tree"].combine_chunks(), rows["pos"].combine_chunks(),
                 pa.array([a + head["siblings"] for a, _ in own], pa.list_(pa.string())), pa.array([s + head["sides"] for _, s in own]),
                 pa.array([head["subroot"]] * len(own)), pa.array([head["root"]] * len(own))],
                names=["tree", "pos", "siblings", "sides", "subroot", "root"])

    return python_map(_with_heads(nodes.select("tree", "pos", "total", "digest"), heads, height), run,
                      f"tree string, pos long, {_ABOVE}")


def _with_heads(nodes: DataFrame, heads: DataFrame, height: int) -> DataFrame:
    """The nodes of each block, led by one row with what stands above it."""
    heads = heads.select("tree", F.col("pos").alias("block"), "siblings", "sides", "subroot", "root")
    return _in_blocks(nodes.unionByName(heads, allowMissingColumns=True), height)


def _versions(leaves: DataFrame, heads: DataFrame, height: int) -> DataFrame:
    """The leaves with all that :func:`manifest` adds."""

    def run(batches):
        for t in _blocks(batches, ["tree", "block"]):
            head, rows = t.slice(0, 1).to_pylist()[0], t.slice(1)
            digests, changed = rows["digest"].to_pylist(), rows["changed"].to_pylist()
            block = Block(digests, _steps(rows["total"][0].as_py(), height))
            out = {n: [] for n in ("siblings", "sides", "copied", "version_root")}
            for i, (leaf, new) in enumerate(zip(digests, changed)):
                near, sides = block.siblings(i)
                siblings, sides = near + head["siblings"], sides + head["sides"]
                path = climb(leaf if new is None else new, siblings, sides)
                out["siblings"].append(siblings)
                out["sides"].append(sides)
                out["copied"].append(None if new is None else path)
                out["version_root"].append(path[-1] if path else leaf if new is None else new)
            n = len(digests)
            yield pa.RecordBatch.from_arrays(
                [pc.cast(rows[ROW].combine_chunks(), rows[ROW].type), rows["digest"].combine_chunks(), rows["pos"].combine_chunks(),
                 pa.array([head["subroot"]] * n, pa.string()), pa.array([head["root"]] * n, pa.string()),
                 pa.array(out["siblings"], pa.list_(pa.string())), pa.array(out["sides"], pa.string()),
                 pa.array(out["copied"], pa.list_(pa.string())), pa.array(out["version_root"], pa.string())],
                names=[ROW, "leaf", "place", "subroot", "root", "siblings", "sides", "copied", "version_root"])

    row = leaves.schema[ROW].dataType.simpleString()
    return python_map(_with_heads(leaves, heads, height), run,
                      f"{ROW} {row}, leaf string, place long, subroot string, root string, siblings array<string>, "
                      "sides string, copied array<string>, version_root string")


def manifest(rows: DataFrame, fields: list[str], key: str = "doc_id", tree: str = "lang", keep: list[str] | None = None,
             changes: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """The columns ``keep`` (default: all) of every row, and its part of the manifest.

    * ``leaf``: H of ``fields`` (see :func:`encoded`); ``place``: its place in its group, by ``key`` (null first);
    * ``subroot``, ``root``: the root of the group's tree and of the tree over the groups (by UTF-8 bytes, null first);
    * ``siblings``, ``sides``: the proof, from the leaf up to ``root``;
    * ``changes`` gives the value that a field has in a version (a column of ``rows``; null: this row makes no version).
      ``copied`` are the nodes that the version copies, from the changed leaf's parent up (null: no version): at every
      level the version differs from the manifest in this one node and shares all others. ``version_root`` is
      the last of them; where there is no version it is computed from the leaf itself in the same way.

    Nulls and empty or very long texts in a field are hashed as they are. Rows with equal keys are ordered by their
    leaves; rows equal in all fields are leaves of their own. A group of one row has its leaf as subroot, and one
    group alone its subroot as root. An empty table gives an empty result. Added columns replace kept ones of the same name.
    """
    names = list(rows.columns if keep is None else keep)

    def changed(c):
        values = {f: e for f, e in (changes or {}).items()}
        if not values:
            return F.lit(None).cast("string")
        any_change = F.greatest(*[v.isNotNull().cast("int") for v in values.values()] + [F.lit(0)]) == 1
        return F.when(any_change, F.sha2(encoded([F.coalesce(values[f].cast("string"), F.col(f).cast("string"))
                                                  if f in values else F.col(f) for f in fields]), 256))

    # The version's leaf is made on the caller's columns, before these are packed.
    mark = "__changed"
    plain = rows.withColumn(mark, changed(None))
    base = packed(plain, names, tree=lambda c: F.coalesce(F.concat(F.lit("1"), c(tree).cast("string")), F.lit("0")),
                  key=lambda c: c(key), digest=lambda c: F.sha2(encoded([c(f) for f in fields]), 256), changed=lambda c: c(mark))
    leaves = ranked(base, "tree", ["key", "digest"], "merkle-leaves")
    # Only one row a block goes up: the rows of callers stay below.
    levels, roots = _rounds(leaves.select("tree", "pos", "total", "digest"), height)
    roots = roots.withColumn("one", F.lit("")).withColumnRenamed("tree", "own")
    tops = ranked(roots, "one", ["own"], "merkle-groups").withColumnRenamed("one", "tree")
    top_levels, top = _rounds(tops.select("tree", "pos", "total", "digest"), height)
    above = top.select("tree", F.lit(0).cast("long").alias("pos"), F.expr("cast(array() as array<string>)").alias("siblings"),
                       F.lit("").alias("sides"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for level in reversed(top_levels):
        above = stored(_descend(level, above, height), "merkle-top")
    heads = (tops.select("own", "round", F.col("pos").alias("at"), "digest").join(above.drop("tree", "subroot"), F.col("at") == F.col("pos"))
             .select(F.col("own").alias("tree"), "round", F.lit(0).cast("long").alias("pos"), "siblings", "sides",
                     F.col("digest").alias("subroot"), "root"))
    heads = stored(heads, "merkle-heads")
    above = None
    for k in range(len(levels) - 1, -1, -1):
        ends = heads.filter(F.col("round") == k).drop("round")  # trees whose root this round makes
        above = ends if above is None else above.unionByName(ends)
        if k:
            above = stored(_descend(levels[k], above, height), "merkle-above")
    out = _versions(leaves.drop("key"), above, height)
    added = ["leaf", "place", "subroot", "root", "siblings", "sides", "copied", "version_root"]
    whole = unpacked(out, [f"k{i}" for i in range(len(names))], *added)
    return whole.select(*[F.col(f"k{i}").alias(n) for i, n in enumerate(names) if n not in added], *added)
