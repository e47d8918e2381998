"""Bounded training samples and the optimiser shared by the numpy models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import unsigned_fraction


def smallest_hashes(rows: DataFrame, per_class: int, seed: int, max_classes: int = 200) -> DataFrame:
    """Of each ``label`` the ``per_class`` rows of smallest key hash, which is added as ``h``; of more than
    ``max_classes`` labels only the most frequent ones.

    Rows are counted per label first. Only the share of a label's rows whose hashes can be among
    the smallest (with four times the room needed) goes on to the exact choice, so what is
    shuffled does not grow with the table.
    """
    counts = (rows.groupBy(F.col("label").alias("counted")).agg(F.count("*").alias("rows"))
              .orderBy(F.desc("rows"), "counted").limit(max_classes))
    h = F.xxhash64("k", F.lit(seed))
    # At most max_classes rows are broadcast.
    some = (rows.withColumn("h", h).join(F.broadcast(counts), F.col("label") == F.col("counted"))
            .filter(unsigned_fraction(F.col("h")) * F.col("rows") <= 4.0 * per_class).drop("counted", "rows"))
    tie = ["text"] if "text" in rows.columns else []
    first = W.partitionBy("label").orderBy("h", *tie)
    return some.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_class).drop("n")


def sample_rows(labelled: DataFrame, per_class: int, max_chars: int | None, seed: int,
                max_classes: int = 200) -> list[tuple[str, str]]:
    """At most ``per_class`` (text, label) pairs a label, of at most ``max_classes`` labels, in a fixed order.

    ``labelled`` has ``k``, ``text`` and ``label`` (string, not null). The texts are whole, or with ``max_chars`` one stretch of
    that length at a hashed place of a longer text. Rows without a text are left out.
    """
    rows = labelled.select("k", "label", "text")
    if max_chars is not None:
        place = F.xxhash64("k", F.lit(seed + 1))
        start = F.pmod(place, F.greatest(F.lit(1), F.length("text") - max_chars + 1)) + 1
        rows = rows.withColumn("text", F.col("text").substr(start.cast("int"), F.lit(max_chars)))
    picked = smallest_hashes(rows, per_class, seed, max_classes).filter("text is not null").collect()
    return [(r["text"], r["label"]) for r in sorted(picked, key=lambda r: (r["h"], r["label"], r["text"]))]


class Adam:
    """Plain Adam on a dictionary of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = min(1.0, 5.0 / (norm + 1e-9))
        for k, g in grads.items():
            g = g * clip
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m = self.m[k] / (1 - 0.9 ** self.step)
            v = self.v[k] / (1 - 0.999 ** self.step)
            self.params[k] -= self.rate * scale * m / (np.sqrt(v) + 1e-8)
