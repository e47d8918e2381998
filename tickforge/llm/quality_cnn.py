"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded and read by learned filters of ``WIDTH`` bytes at every
``STRIDE``-th byte. Filter values are max-pooled over overlapping chunks of ``CHUNK`` bytes
(each starts half a chunk after the one before, so the chunks cover the whole document and
every place lies in two of them). A hidden layer turns a chunk's maxima into one logit, and
the document's probability is the logistic function of the mean over all its chunks.

Documents are processed in pieces of bounded size, so memory does not grow with a text. Training runs
in numpy on the driver, on a bounded sample of labelled documents; the weights go to the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.bpe import small_batches
from tickforge.llm.common import python_map
from tickforge.llm.training import Adam, sample_rows, smallest_hashes

WIDTH, STRIDE, CHUNK = 8, 2, 256
HALF = CHUNK // 2          # bytes between starts of chunks
SPOTS = HALF // STRIDE     # filter places in half a chunk
PAD = 256                  # symbol behind the end of a text


def halves(raw: bytes) -> int:
    """Number of half chunks of a text; at least two, so that there is a chunk."""
    return max(2, -(-len(raw) // HALF))


def symbols(pieces: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all half chunks (row: a half and the WIDTH bytes behind it), and halves a piece.

    A piece is bytes and a number of halves; bytes that it lacks are padding.
    """
    count = np.array([n for _, n in pieces])
    out = np.full((int(count.sum()), HALF + WIDTH), PAD, dtype=np.int64)
    at = 0
    for raw, n in pieces:
        row = np.full(n * HALF + WIDTH, PAD, dtype=np.int64)
        row[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
        out[at:at + n] = sliding_window_view(row, HALF + WIDTH)[::HALF]
        at += n
    return out, count


class ByteCnn:
    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def fresh(cls, filters: int, embed: int, hidden: int, seed: int) -> "ByteCnn":
        rng = np.random.default_rng(seed)
        n = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        return cls({"e": rng.normal(0, 0.5, (PAD + 1, embed)).astype(np.float32),
                    "w": n(WIDTH * embed, filters), "h": n(filters, hidden), "hb": np.zeros(hidden, np.float32),
                    "o": n(hidden, 1)[:, 0], "ob": np.zeros(1, np.float32)})

    def _places(self, x: np.ndarray) -> np.ndarray:
        """The bytes that each filter place sees (place, WIDTH); a filter may look over its half's end."""
        return sliding_window_view(x, WIDTH, axis=1)[:, :HALF:STRIDE].reshape(-1, WIDTH)

    def half_maxima(self, x: np.ndarray) -> np.ndarray:
        """Filter maxima of every half chunk."""
        e, w = self.p["e"], self.p["w"]
        seen = e[self._places(x)].reshape(-1, w.shape[0]) @ w
        return seen.reshape(-1, SPOTS, w.shape[1]).max(axis=1)

    def chunk_logits(self, maxima: np.ndarray) -> np.ndarray:
        """Logits of the chunks made of two neighbouring halves each."""
        p = self.p
        top = np.maximum(maxima[:-1], maxima[1:])
        return np.tanh(top @ p["h"] + p["hb"]) @ p["o"] + p["ob"]

    def scores(self, texts: list[str | None], piece: int = 1_000_000) -> np.ndarray:
        """Probability that each whole text is good; null counts as empty."""
        return self._scores([(t or "").encode("utf-8", "surrogatepass") for t in texts], piece)

    def _scores(self, raw: list[bytes], piece: int) -> np.ndarray:
        total = np.zeros(len(raw))
        for held in stretches(raw, piece):
            self._add(total, held)
        return 1 / (1 + np.exp(-total / np.array([halves(r) - 1 for r in raw])))

    def _add(self, total: np.ndarray, held: list[tuple[int, bytes, int]]) -> None:
        x, count = symbols([(raw, n) for _, raw, n in held])
        logits = self.chunk_logits(self.half_maxima(x))
        owner, inside = _owners(held, count)
        np.add.at(total, owner[inside], logits[inside])

    def gradients(self, texts: list[bytes], y: np.ndarray, piece: int = 64_000) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over whole documents and its gradients.

        A document's logit is a mean over its chunks, so its probability is found first, and then every stretch of it
        gives its part of the gradients: memory is bounded by ``piece``, not by the texts.
        """
        prob = self._scores(texts, piece)
        loss = -float(np.mean(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9)))
        share = (prob - y) / len(y) / np.array([halves(t) - 1 for t in texts])
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        for held in stretches(texts, piece):
            for k, v in self._backward(held, share).items():
                g[k] += v
        return loss, g

    def _backward(self, held: list[tuple[int, bytes, int]], share: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients through the chunks of some stretches; ``share``: the gradient of each document's chunk logits."""
        p = self.p
        x, count = symbols([(raw, n) for _, raw, n in held])
        places = self._places(x)
        seen = p["e"][places].reshape(len(places), -1)
        values = (seen @ p["w"]).reshape(-1, SPOTS, p["w"].shape[1])
        best = values.argmax(axis=1)
        maxima = np.take_along_axis(values, best[:, None], axis=1)[:, 0]
        left = maxima[:-1] >= maxima[1:]
        top = np.where(left, maxima[:-1], maxima[1:])
        hid = np.tanh(top @ p["h"] + p["hb"])
        owner, inside = _owners(held, count)
        dl = (share[owner] * inside).astype(p["w"].dtype)
        dpre = dl[:, None] * p["o"] * (1 - hid * hid)
        g = {"o": hid.T @ dl, "ob": dl.sum(keepdims=True), "h": top.T @ dpre, "hb": dpre.sum(0)}
        dtop = dpre @ p["h"].T
        dmax = np.zeros_like(maxima)
        dmax[:-1] += dtop * left
        dmax[1:] += dtop * ~left
        # Each maximum comes from one place: only those places get a gradient.
        at = best + np.arange(len(best))[:, None] * SPOTS
        flat, f = at.reshape(-1), np.tile(np.arange(at.shape[1]), len(at))
        dv = dmax.reshape(-1)
        rows, back = np.unique(flat, return_inverse=True)
        dvals = np.zeros((len(rows), at.shape[1]), p["w"].dtype)
        np.add.at(dvals, (back, f), dv)
        g["w"] = seen[rows].T @ dvals
        de = (dvals @ p["w"].T).reshape(len(rows), WIDTH, -1)
        g["e"] = np.zeros_like(p["e"])
        np.add.at(g["e"], places[rows], de)
        return g


def stretches(raw: list[bytes], piece: int, together: int = 64_000):
    """Whole texts as lists of ``(text, bytes, halves)``: about ``together`` bytes a list, at most ``piece`` of a text at once.

    A stretch is a run of halves; the next one of the same text begins with its last half, so no chunk is lost or doubled.
    """
    step = max(1, piece // HALF)
    held, size = [], 0
    for k, r in enumerate(raw):
        n = halves(r)
        for a in range(0, n - 1, step):
            b = min(n, a + step + 1)
            held.append((k, r[a * HALF:b * HALF + WIDTH if b < n else None], b - a))
            size += b - a
            if size * HALF > together:
                yield held
                held, size = [], 0
    if held:
        yield held


def _owners(held: list[tuple[int, bytes, int]], count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of every pair of neighbouring halves, and whether both are of the same stretch."""
    inside = np.ones(int(count.sum()) - 1, dtype=bool)
    inside[np.cumsum(count)[:-1] - 1] = False
    return np.repeat([k for k, _, _ in held], count)[:-1], inside


def train(sample: list[tuple[str, str]], filters: int = 24, embed: int = 6, hidden: int = 12,
          steps: int = 350, batch: int = 48, rate: float = 0.01, seed: int = 3) -> ByteCnn:
    """Fit on (text, "1" or "0") pairs, as many of either label in a batch; reruns agree."""
    rng = np.random.default_rng(seed)
    net = ByteCnn.fresh(filters, embed, hidden, seed)
    raw = [t.encode("utf-8", "surrogatepass") for t, _ in sample]
    y = np.array([label == "1" for _, label in sample], dtype=np.float32)
    sides = [np.flatnonzero(y == v) for v in (0, 1)]
    if not all(len(s) for s in sides):
        return net
    adam = Adam(net.p, rate)
    for step in range(steps):
        pick = np.concatenate([rng.choice(s, batch // 2) for s in sides])
        _, g = net.gradients([raw[i] for i in pick], y[pick])
        adam.update(g, 1.0 - 0.95 * step / steps)
    return net


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        per_label: int = 1500, seed: int = 3) -> ByteCnn:
    """Train on the whole texts of at most ``per_label`` documents of either label (rows without label are left out).

    The documents are chosen from ``labels`` by key, so that only their texts are moved. Contradicting labels are left out.
    """
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("q")).filter("q in (0, 1)")
             .groupBy("k").agg(F.min("q").alias("q"), F.max("q").alias("q2")).filter("q = q2"))
    chosen = smallest_hashes(known.select("k", F.col("q").cast("string").alias("label")), per_label, seed)
    chosen = chosen.select(F.col("k").alias("lk"), "label")
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("k") == F.col("lk"))  # at most two times per_label rows
    return train(sample_rows(rows.select("k", "text", "label"), per_label, None, seed))


def classify(docs: DataFrame, model: ByteCnn, text: str = "text", score: str = "score",
             predicted: str = "predicted", max_bytes: int = 4_000_000) -> DataFrame:
    """Add ``score`` (0 to 1, higher: good) and ``predicted`` (1 if score >= 0.5) to every row.

    Whole texts are scored; null counts as empty, and an empty text is one chunk of padding. All columns pass
    through, columns that have the added names already are replaced; nothing is shuffled.
    """
    docs = docs.drop(score, predicted)
    params, at = model.p, docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType()),
                           T.StructField(predicted, T.IntegerType())])

    def run(batches):
        net = ByteCnn(params)
        for b in small_batches(batches, at, max_bytes):
            s = net.scores(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*b.schema.names, score, predicted])

    return python_map(docs, run, schema)
