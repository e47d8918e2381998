"""Hard negatives by angular triangle filtering.

Vectors are rounded to integers, and scores are exact integer inner products. For an anchor the best rows of its own label are its
positives, and the hard negatives of a positive are the best rows of other labels whose score lies in a band below the
positive's score.

1. Every vector's angles to some reference directions are stored with it, and its length. (The directions are vectors of a
   bounded sample that lie far apart, filled up with random ones.)
2. Rows are dealt to groups by a hash of their key, so a group is an even share of the rows whatever they hold. Inside a group they
   are sorted by label, nearest direction and angle to it, and cut into windows of neighbours; a window keeps
   the interval of each of its angles and of its lengths.
3. By the triangle inequality of angles, an anchor's angle to any vector of a window lies between the largest gap between the
   anchor's angles and the window's intervals and the smallest of their sums. The cosine falls with the angle, so this gives
   an interval of cosines; times the lengths, and widened by more than all rounding errors, it bounds the scores.
4. A window whose bounds miss what an anchor still looks for (more than its fifth best so far, inside its band) is
   left out; the others are scored. Nothing else is dropped, so the result is that of scoring all pairs.

The anchors, a stated query set, meet every group in blocks; of each group and anchor only the best few rows come back. Positives and
negatives are found by two such passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import python_map, stored

#: Errors of stored angles: rounding to 32 bits and the arc cosine near its ends stay below a quarter of it.
ANGLE_SLACK = 1e-6
NONE = np.iinfo(np.int64).min
FAR = np.iinfo(np.int64).max


def quantised(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.floor(values * scale) + 0.0


def directions(sample: list[np.ndarray], dim: int, number: int, seed: int) -> np.ndarray:
    """``number`` unit vectors: sampled ones of this size, each the farthest from those before, then random ones."""
    have = [v / np.linalg.norm(v) for v in sample if len(v) == dim and np.isfinite(v).all() and np.linalg.norm(v) > 0]
    out: list[np.ndarray] = []
    if have:
        x, near = np.array(have), np.full(len(have), -2.0)
        at = 0
        while len(out) < number and near.min(initial=1.0) < 0.999:
            out.append(x[at])
            near = np.maximum(near, x @ x[at])
            at = int(near.argmin())
    rng = np.random.default_rng([seed, dim])
    while len(out) < number:
        v = rng.normal(size=dim)
        out.append(v / max(np.linalg.norm(v), 1e-300))
    return np.array(out).reshape(number, dim)


def angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the rows of ``q`` and their angles to ``refs``; a zero vector is at right angles to all."""
    top = np.abs(q).max(axis=1, initial=0.0)
    safe = q / np.where(top > 0, top, 1.0)[:, None]
    size = np.sqrt((safe * safe).sum(axis=1))
    unit = safe / np.where(size > 0, size, 1.0)[:, None]
    return size * top, np.arccos(np.clip(unit @ refs.T, -1.0, 1.0))


def _packed(q: np.ndarray) -> bytes:
    """32-bit integers where they are wide enough, else doubles."""
    return (q.astype("<i4") if not len(q) or np.abs(q).max() < 2 ** 31 else q.astype("<f8")).tobytes()


def _vector(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * dim else "<f8").astype(np.float64)


def _prepared(rows: DataFrame, refs: Callable[[int], np.ndarray], scale: float) -> DataFrame:
    """``key, label, dim, raw, size, near``: rounded vectors with lengths and angles (32-bit); others are left out."""

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            vectors = b.column(2)
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            keys, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lengths)
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                x = np.array([flat[e - dim:e] for e in ends[at]]).reshape(len(at), dim)
                q = quantised(x, scale)
                ok = np.isfinite(q).all(axis=1)
                at, q = at[ok], q[ok]
                if dim not in known:
                    known[dim] = refs(dim)
                size, near = angles(q, known[dim])
                for i, v, s, a in zip(at.tolist(), q, size.tolist(), near.astype("<f4")):
                    for column, value in zip(out, (keys[i], labels[i], dim, _packed(v), s, a.tobytes())):
                        column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["key", "label", "dim", "raw", "size", "near"])

    return python_map(rows, run, "key long, label string, dim int, raw binary, size double, near binary")


class Windows:
    """The rows of one group of one dimension, in windows of neighbours with bounds."""

    def __init__(self, keys, labels, dim, raws, sizes, nears, width):
        near = np.array([np.frombuffer(a, "<f4") for a in nears], dtype=np.float64)
        labels, closest = np.array(labels, dtype=object), near.argmin(axis=1)
        order = np.lexsort((near[np.arange(len(near)), closest], closest, np.unique(labels.astype(str), return_inverse=True)[1]))
        self.keys, self.q = np.array(keys, dtype=np.int64)[order], [raws[i] for i in order]
        labels, near, sizes, self.dim = labels[order], near[order], np.array(sizes)[order], dim
        starts, start = [], 0
        for i in range(1, len(order) + 1):
            if i == len(order) or labels[i] != labels[start] or i - start == width:
                starts.append((start, i))
                start = i
        self.spans = starts
        self.label = np.array([labels[a] for a, _ in starts], dtype=object)
        self.low = np.array([near[a:z].min(axis=0) for a, z in starts]) - ANGLE_SLACK
        self.high = np.array([near[a:z].max(axis=0) for a, z in starts]) + ANGLE_SLACK
        self.size_low = np.array([sizes[a:z].min() for a, z in starts])
        self.size_high = np.array([sizes[a:z].max() for a, z in starts])
        self.scored = self.seen = 0

    def bounds(self, near: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of every anchor (row) in every window (column)."""
        shape = (len(near), len(self.spans))
        least, most = np.zeros(shape), np.full(shape, math.pi)
        for j in range(near.shape[1]):
            a = near[:, j:j + 1]
            least = np.maximum(least, np.maximum(a - ANGLE_SLACK - self.high[:, j], self.low[:, j] - a - ANGLE_SLACK))
            total = a + ANGLE_SLACK + self.high[:, j]
            turned = 2 * math.pi - (a - ANGLE_SLACK + self.low[:, j])
            most = np.minimum(most, np.minimum(total, turned))
        top, bottom = np.cos(least), np.cos(np.maximum(most, least))
        slack = size[:, None] * self.size_high * 1e-9 + 1.0
        high = size[:, None] * np.where(top >= 0, top * self.size_high, top * self.size_low) + slack
        low = size[:, None] * np.where(bottom >= 0, bottom * self.size_low, bottom * self.size_high) - slack
        return low, high

    def scores(self, w: int, vectors: np.ndarray, size: float) -> np.ndarray:
        """Exact scores of anchors with the rows of a window; beyond 64 bits they are held at the limits."""
        a, z = self.spans[w]
        rows = np.array([_vector(r, self.dim) for r in self.q[a:z]]).reshape(z - a, self.dim)
        if size * self.size_high[w] < 2.0 ** 52:  # no partial sum leaves the integers that a double holds
            return (vectors @ rows.T).astype(np.int64)
        whole = [[int(c) for c in r] for r in rows]
        return np.array([[max(NONE + 1, min(FAR, sum(x * y for x, y in zip([int(c) for c in v], r)))) for r in whole]
                         for v in vectors], dtype=np.int64)


def _best(scores: np.ndarray, keys: np.ndarray, new: np.ndarray, names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best of what was held and what is new in each row: higher scores, then smaller keys."""
    s = np.concatenate([scores, new], axis=1)
    k = np.concatenate([keys, np.where(new == NONE, FAR, np.broadcast_to(names, new.shape))], axis=1)
    order = np.lexsort((k, ~s))[:, :n]
    return np.take_along_axis(s, order, axis=1), np.take_along_axis(k, order, axis=1)


def _positives(windows: Windows, anchors: dict, n: int):
    """(anchor, score, key) of the best rows of an anchor's own label."""
    names, labels = anchors["key"], anchors["label"]
    best, who = np.full((len(names), n), NONE), np.full((len(names), n), FAR)
    _, high = windows.bounds(anchors["near"], anchors["size"])
    own = labels[:, None] == windows.label
    high = np.where(own, high, -np.inf)
    for w in np.argsort(-high.max(axis=0)):
        at = np.flatnonzero(own[:, w] & (high[:, w] >= best[:, -1]))
        windows.seen += int(own[:, w].sum())
        windows.scored += len(at)
        if not len(at):
            continue
        a, z = windows.spans[w]
        s = windows.scores(w, anchors["q"][at], float(anchors["size"][at].max()))
        s[names[at][:, None] == windows.keys[a:z]] = NONE
        new = np.flatnonzero((s >= best[at, -1:]).any(axis=1))
        best[at[new]], who[at[new]] = _best(best[at[new]], who[at[new]], s[new], windows.keys[a:z], n)
    for i, c in np.argwhere(best != NONE).tolist():
        yield int(names[i]), None, int(who[i, c]), int(best[i, c])


def _negatives(windows: Windows, anchors: dict, n: int, low_percent: int, high_percent: int):
    """(anchor, band, key, score) of the best rows of other labels inside the band below each positive's score."""
    names, labels, bands = anchors["key"], anchors["label"], anchors["bands"]
    width = max(map(len, bands))
    top, floor = np.full((len(names), width), NONE), np.full((len(names), width), FAR)
    for i, b in enumerate(bands):
        for c, p in enumerate(b):  # in Python's integers: low * p <= 100 * score <= high * p
            lowest, highest = -(-low_percent * p // 100), high_percent * p // 100
            if lowest <= highest:
                floor[i, c], top[i, c] = max(lowest, NONE + 1), min(highest, FAR)
    best = np.full((len(names), width, n), NONE)
    who = np.full((len(names), width, n), FAR)
    low, high = windows.bounds(anchors["near"], anchors["size"])
    other = labels[:, None] != windows.label
    for w in np.argsort(-np.where(other, high, -np.inf).max(axis=0)):
        still = np.maximum(floor, best[:, :, -1])
        open_ = other[:, w, None] & (high[:, w, None] >= still) & (low[:, w, None] <= top)
        at = np.flatnonzero(open_.any(axis=1))
        windows.seen += int(other[:, w].sum())
        windows.scored += len(at)
        if not len(at):
            continue
        a, z = windows.spans[w]
        s = windows.scores(w, anchors["q"][at], float(anchors["size"][at].max()))
        for c in range(width):
            inside = (s <= top[at, c, None]) & (s >= still[at, c, None])
            new = np.flatnonzero(inside.any(axis=1))
            if len(new):
                rows = at[new]
                best[rows, c], who[rows, c] = _best(best[rows, c], who[rows, c], np.where(inside[new], s[new], NONE),
                                                    windows.keys[a:z], n)
    for i, c, k in np.argwhere(best != NONE).tolist():
        yield int(names[i]), int(bands[i][c]), int(who[i, c, k]), int(best[i, c, k])


_FOUND = "anchor long, band long, found long, score long"


def _in_groups(rows: DataFrame, anchors: DataFrame, groups: int, window: int, block: int, search) -> DataFrame:
    """``search(windows, anchors)`` over all rows of each group and all anchors; ``anchors`` are rows with ``bands``."""
    g = F.pmod(F.xxhash64("key", F.lit(29)), F.lit(groups)).cast("int")
    own = rows.withColumn("g", g).withColumn("kind", F.lit(0)).withColumn("bands", F.lit(None).cast("array<long>"))
    asked = anchors.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1))
    cols = ["g", "kind", "key", "label", "dim", "raw", "size", "near", "bands"]
    dealt = own.select(*cols).union(asked.select(*cols)).repartition("g").sortWithinPartitions("g", "kind", "dim")

    def run(batches):
        group, held, sets, told = None, [], {}, [0, 0]

        def build():
            by_dim: dict[int, list] = {}
            for r in held:
                by_dim.setdefault(r[4], []).append(r)
            return {d: Windows([r[2] for r in rs], [r[3] for r in rs], d, [r[5] for r in rs], [r[6] for r in rs],
                               [r[7] for r in rs], window) for d, rs in by_dim.items()}

        for b in batches:
            rows_ = list(zip(*(c.to_pylist() for c in b.columns)))
            out, asking = [], []

            def answer():
                for dim in sorted({r[4] for r in asking}):
                    mine = [r for r in asking if r[4] == dim]
                    for i in range(0, len(mine) if dim in sets else 0, block):
                        part = mine[i:i + block]
                        facts = {"key": np.array([r[2] for r in part]), "label": np.array([r[3] for r in part], dtype=object),
                                 "q": np.array([_vector(r[5], dim) for r in part]).reshape(len(part), dim),
                                 "size": np.array([r[6] for r in part]),
                                 "near": np.array([np.frombuffer(r[7], "<f4") for r in part], dtype=np.float64),
                                 "bands": [r[8] or [] for r in part]}
                        out.extend(search(sets[dim], facts))
                asking.clear()

            for r in rows_:
                if r[0] != group:
                    answer()
                    group, held, sets = r[0], [], None
                if r[1] == 0:
                    held.append(r)
                else:
                    if sets is None:
                        sets, held = build(), []
                    asking.append(r)
            answer()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor", "band", "found", "score"])

    return python_map(dealt, run, _FOUND)


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(rows: DataFrame, is_anchor: Callable[[Column], Column], key: str = "vec_id", label: str = "label",
         vector: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 5, low_percent: int = 80,
         high_percent: int = 100, references: int = 16, sample_rows: int = 1024, window: int = 128, block: int = 256,
         group_bytes: int = 64 << 20, seed: int = 5) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` says of a key whether its row is an anchor. Scores are inner products of ``floor(scale * x)``; higher scores
    come first, equal ones by smaller key. An anchor's positives are its first ``positives`` other rows of the same label; for each,
    its negatives are the first ``negatives`` rows of other labels with ``low_percent * positive <= 100 * score <=
    high_percent * positive``. A positive without such rows gives none.

    Rows with a null key, label or vector, or with a component that is null, not finite, or beyond a double after
    scaling, take no part. Vectors of different lengths are never compared; empty and zero vectors score 0. Of rows
    with one key, one takes part (the smallest by label and vector). Scores beyond 64 bits are held at the limits. An empty table gives an empty
    result; other columns are not read.

    The reference directions come from the ``sample_rows`` rows of smallest key hash: they decide how much is left out, never
    what is found. A group holds at most about ``group_bytes`` of vectors.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
                        F.col(vector).cast("array<double>").alias("v")).filter("key is not null and label is not null and v is not null")
    drawn = plain.orderBy(F.xxhash64("key", F.lit(seed)), "key").select("v").limit(sample_rows).collect()
    sample = [quantised(np.array([np.nan if c is None else c for c in r[0]], dtype=np.float64), scale) for r in drawn]
    base = _prepared(plain, lambda dim: directions(sample, dim, references, seed), scale)
    kept = base.groupBy("key").agg(F.min(F.struct("label", "dim", "raw", "size", "near")).alias("r")).select("key", "r.*")
    table = stored(kept, "mine-rows")
    n, bytes_ = table.agg(F.count("*"), F.sum(F.length("raw") + F.lit(4 * references + 32))).first()
    # An even share of the rows, small enough to be held; few enough that the anchors are not copied too often.
    share = max(2048, min(math.ceil(n / 64), group_bytes * n // (bytes_ or 1)))
    groups = max(1, math.ceil(n / share))
    anchors = table.filter(is_anchor(F.col("key")))
    near = _in_groups(table, anchors.withColumn("bands", F.lit(None).cast("array<long>")), groups, window, block,
                      lambda w, a: _positives(w, a, positives))
    best = stored(_first(near.select("anchor", "found", "score"), ["anchor"], positives).drop("rank"), "mine-positives")
    bands = best.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("bands"))
    asked = anchors.join(bands, F.col("key") == F.col("anchor")).drop("anchor")
    far = _in_groups(table, asked, groups, window, block, lambda w, a: _negatives(w, a, negatives, low_percent, high_percent))
    hard = _first(far, ["anchor", "band"], negatives).select(
        F.col("anchor").alias("na"), F.col("band").alias("nb"), F.col("found").alias("negative_id"),
        F.col("score").alias("negative_score"), "rank")
    out = best.join(hard, (F.col("anchor") == F.col("na")) & (F.col("score") == F.col("nb")))
    return out.select(F.col("anchor").alias("anchor_id"), F.col("found").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      "negative_id", F.col("score").alias("positive_score"), "negative_score")
