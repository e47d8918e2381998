r"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text's letters (lower-cased; runs of letters and combining marks, one space between
them) in both directions and gives every byte position probabilities of all languages from the two hidden
states there. A document's probabilities pool the positions of all its letters: the mean of their logarithms,
normalised. What is no letter or mark (digits, punctuation, white space) says nothing about a language and counts
for nothing.

The state goes on from word to word. Texts are read in windows of ``CORE`` bytes, cut between characters, with
``CONTEXT`` bytes more on both sides that only bring the states up to date; so a position sees at least that much of
the text in both directions, every position counts once, and windows of all texts are evaluated side by side.

Training is backpropagation through time in numpy on the driver, on a bounded sample of
labelled documents, of which all windows may be drawn; the weights (a few thousand numbers) go to the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.bpe import small_batches
from tickforge.llm.common import python_map
from tickforge.llm.training import Adam, sample_rows

#: Letters with their marks; at least one letter.
RUN = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
CORE, CONTEXT = 224, 16
SIDE_BY_SIDE = 1024  # windows evaluated at once
START, END, PAD = 256, 257, 258
SPACE = 32


def letters(text: str) -> np.ndarray:
    """The symbols of a text: bytes of its letter runs with spaces between, marks at both ends; empty without a letter."""
    found = RUN.findall(text.lower())
    if not found:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(" ".join(found).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return np.concatenate([[START], raw, [END]]).astype(np.int64)


def windows(symbols: np.ndarray, core: int = CORE, context: int = CONTEXT) -> list[tuple[int, int, int, int]]:
    """``(from, first, last, to)``: cores ``first:last`` that cover the symbols, and how far their context reaches.

    Both are cut between characters; context may be up to three bytes longer for that.
    """
    n = len(symbols)
    whole = (symbols < 0x80) | (symbols >= 0xC0)  # no continuation byte

    def border(at: int) -> int:
        while 0 < at < n and not whole[at]:
            at -= 1
        return max(0, min(n, at))

    cuts = [0]
    while cuts[-1] < n:
        cuts.append(n if cuts[-1] + core >= n else max(border(cuts[-1] + core), cuts[-1] + 1))
    return [(border(a - context), a, b, min(n, border(b + context + 3))) for a, b in zip(cuts, cuts[1:])]


def _matrix(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (time, piece) and lengths."""
    size = np.array([len(p) for p in pieces])
    out = np.full((int(size.max()), len(pieces)), PAD, dtype=np.int64)
    for k, p in enumerate(pieces):
        out[:len(p), k] = p
    return out, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    def __init__(self, params: dict[str, np.ndarray], labels: list[str]):
        self.p, self.labels = params, labels
        self.h = params["uf"].shape[0]

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, embed: int, seed: int) -> "BiGru":
        rng = np.random.default_rng(seed)
        n = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        p = {"e": rng.normal(0, 0.5, (PAD + 1, embed)).astype(np.float32)}
        for d in "fb":
            p |= {f"w{d}": n(embed, 3 * hidden), f"b{d}": np.zeros(3 * hidden, np.float32),
                  f"u{d}": n(hidden, 2 * hidden), f"c{d}": n(hidden, hidden)}
        p |= {"o": n(2 * hidden, len(labels)), "ob": np.zeros(len(labels), np.float32)}
        return cls(p, labels)

    def _scan(self, x: np.ndarray, live: np.ndarray, d: str, keep: bool):
        """Hidden states along the first axis of ``x`` (symbols); pads leave the state alone."""
        p, h, steps = self.p, self.h, []
        inputs = p["e"] @ p[f"w{d}"] + p[f"b{d}"]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((*x.shape, h), np.float32)
        for t in range(len(x)):
            a = inputs[x[t]]
            zr = _sigmoid(a[:, :2 * h] + state @ p[f"u{d}"])
            z, r = zr[:, :h] * live[t], zr[:, h:]
            rs = r * state
            c = np.tanh(a[:, 2 * h:] + rs @ p[f"c{d}"])
            new = state + z * (c - state)
            if keep:
                steps.append((state, zr[:, :h], r, rs, c))
            out[t] = state = new
        return out, steps

    def log_probs(self, x: np.ndarray, size: np.ndarray, keep: bool = False):
        """Log probabilities (time, piece, label) at every position."""
        live = (np.arange(len(x))[:, None] < size)[..., None].astype(np.float32)
        f, sf = self._scan(x, live, "f", keep)
        b, sb = self._scan(x[::-1], live[::-1], "b", keep)
        both = np.concatenate([f, b[::-1]], axis=2)
        y = both @ self.p["o"] + self.p["ob"]
        y -= y.max(axis=2, keepdims=True)
        y -= np.log(np.exp(y).sum(axis=2, keepdims=True))
        return y, (live, both, sf, sb)

    def scored(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """:meth:`log_probs` as (time, label, piece), for scoring: the same steps in place, pieces along the last axis."""
        p, h = self.p, self.h
        out = np.empty((len(x), h, x.shape[1]), np.float32)
        least, y = int(size.min()), 0.0
        for d, top in (("f", p["o"][:h]), ("b", p["o"][h:])):
            table = np.ascontiguousarray((p["e"] @ p[f"w{d}"] + p[f"b{d}"]).T)
            u, c = np.ascontiguousarray(p[f"u{d}"].T), np.ascontiguousarray(p[f"c{d}"].T)
            table[:2 * h] *= 0.5  # the sigmoid is 0.5 * tanh(0.5 * x) + 0.5
            u *= 0.5
            state = np.zeros((h, x.shape[1]), np.float32)
            for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
                a = table.take(x[t], axis=1)
                zr, new = a[:2 * h], a[2 * h:]
                zr += u @ state
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                zr[h:] *= state
                new += c @ zr[h:]
                np.tanh(new, out=new)
                new -= state
                new *= zr[:h]
                if t >= least:
                    new *= t < size  # pads leave the state alone
                state = np.add(state, new, out=out[t])
            y = y + top.T @ out
        y += self.p["ob"][:, None]
        y -= y.max(axis=1, keepdims=True)
        y -= np.log(np.exp(y).sum(axis=1, keepdims=True))
        return y

    def gradients(self, x: np.ndarray, size: np.ndarray, target: np.ndarray, counts: np.ndarray | None = None):
        """Loss (mean over the positions that count; default: all) and gradients by backpropagation through time."""
        p, h = self.p, self.h
        y, (live, both, sf, sb) = self.log_probs(x, size, keep=True)
        hot = np.zeros_like(y)
        hot[:, np.arange(x.shape[1]), target] = 1
        seen = live if counts is None else live * counts[..., None].astype(live.dtype)
        total = max(1.0, float(seen.sum()))
        loss = -float((y * hot * seen).sum() / total)
        dy = (np.exp(y) - hot) * seen / total
        k = y.shape[2]
        g = {"o": both.reshape(-1, 2 * h).T @ dy.reshape(-1, k), "ob": dy.sum((0, 1)),
             "e": np.zeros_like(p["e"])}
        dboth = dy @ p["o"].T
        for d, steps, xs, ls, dh in (("f", sf, x, live, dboth[:, :, :h]),
                                     ("b", sb, x[::-1], live[::-1], dboth[::-1, :, h:])):
            gu, gc = np.zeros_like(p[f"u{d}"]), np.zeros_like(p[f"c{d}"])
            da = np.zeros((*xs.shape, 3 * h), np.float32)
            back = np.zeros((xs.shape[1], h), np.float32)
            for t in range(len(xs) - 1, -1, -1):
                state, z, r, rs, c = steps[t]
                dn = back + dh[t]
                zl = z * ls[t]
                dc = dn * zl * (1 - c * c)
                dz = dn * (c - state) * ls[t] * z * (1 - z)
                drs = dc @ p[f"c{d}"].T
                dr = drs * state * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                gc += rs.T @ dc
                gu += state.T @ dzr
                back = dn * (1 - zl) + drs * r + dzr @ p[f"u{d}"].T
                da[t, :, :2 * h], da[t, :, 2 * h:] = dzr, dc
            flat = da.reshape(-1, 3 * h)
            by_symbol = np.zeros((PAD + 1, 3 * h), np.float32)
            np.add.at(by_symbol, xs.reshape(-1), flat)
            g[f"b{d}"], g[f"u{d}"], g[f"c{d}"] = flat.sum(0), gu, gc
            g[f"w{d}"] = p["e"].T @ by_symbol
            g["e"] += by_symbol @ p[f"w{d}"].T
        return loss, g

    def pooled(self, symbols: list[np.ndarray]) -> np.ndarray:
        """Mean log probabilities (text, label) over the letters of each text; NaN for a text without any."""
        cut = [(k, *w) for k, s in enumerate(symbols) for w in windows(s)]
        cut.sort(key=lambda w: w[4] - w[1])  # windows of like lengths waste no time on padding
        sums = np.zeros((len(symbols), len(self.labels) + 1))
        for i in range(0, len(cut), SIDE_BY_SIDE):
            some = cut[i:i + SIDE_BY_SIDE]
            x, size = _matrix([symbols[k][lo:hi] for k, lo, _, _, hi in some])
            first, last = (np.array([w[j] - w[1] for w in some]) for j in (2, 3))
            mask = counting(x, first, last)
            held = np.concatenate([np.einsum("tkn,tn->nk", self.scored(x, size), mask), mask.sum(0)[:, None]], axis=1)
            np.add.at(sums, [w[0] for w in some], held)
        with np.errstate(invalid="ignore", divide="ignore"):
            return sums[:, :-1] / sums[:, -1:]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Label and score of each whole text; equal texts are read once."""
        each = {t: letters(t) for t in set(texts) if t}
        known = {t: k for k, t in enumerate(t for t, s in each.items() if len(s))}
        mean = self.pooled([each[t] for t in known])
        prob = np.exp(mean - mean.max(axis=1, keepdims=True)) if len(known) else mean
        names, scores = [], []
        for t in texts:
            k = known.get(t)
            best = None if k is None else int(prob[k].argmax())
            names.append("und" if best is None else self.labels[best])
            scores.append(0.0 if best is None else float(prob[k, best] / prob[k].sum()))
        return names, scores


def counting(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which positions (time, window) count: letters of the core."""
    at = np.arange(len(x))[:, None]
    return ((at >= first) & (at < last) & (x < 256) & (x != SPACE)).astype(np.float32)


def train(sample: list[tuple[str, str]], hidden: int = 8, embed: int = 8, core: int = 40, context: int = 8,
          steps: int = 350, batch: int = 160, rate: float = 0.012, seed: int = 5) -> BiGru:
    """Fit the network on (text, label) pairs; reruns on equal pairs give equal weights.

    Every step draws windows (of ``core`` bytes and their context) from all those of the whole texts, as many of each
    label. Without any letter in the sample the network knows no language.
    """
    rng = np.random.default_rng(seed)
    labels = sorted({y for _, y in sample})
    texts = [letters(t) for t, _ in sample]
    cut = [(k, *w) for k, s in enumerate(texts) for w in windows(s, core, context)]
    net = BiGru.fresh(labels, hidden, embed, seed)
    if not cut or len(labels) < 2:
        return net
    target = np.array([labels.index(sample[w[0]][1]) for w in cut])
    of_label = [np.flatnonzero(target == k) for k in range(len(labels))]
    of_label = [i for i in of_label if len(i)]
    adam = Adam(net.p, rate)
    for step in range(steps):
        pick = np.concatenate([rng.choice(i, batch // len(of_label) + 1) for i in of_label])
        some = [cut[i] for i in pick]
        x, n = _matrix([texts[k][lo:hi] for k, lo, _, _, hi in some])
        first, last = (np.array([w[j] - w[1] for w in some]) for j in (2, 3))
        _, g = net.gradients(x, n, target[pick], counting(x, first, last))
        adam.update(g, 1.0 - 0.9 * step / steps)
    return net


def fit(docs: DataFrame, labels_from: DataFrame | None = None, key: str = "doc_id", text: str = "text",
        lang: str = "lang", per_language: int = 500, max_languages: int = 200, seed: int = 5) -> BiGru:
    """Train on the whole texts of at most ``per_language`` rows a language of ``labels_from`` (or ``docs``) with a label.

    Of more than ``max_languages`` labels those with the most rows are learned, so what the driver holds is
    bounded by the two parameters and the texts' lengths.
    """
    src = docs if labels_from is None else labels_from
    rows = src.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).cast("string").alias("label"))
    return train(sample_rows(rows.filter("label is not null"), per_language, None, seed, max_languages))


def identify(docs: DataFrame, model: BiGru, text: str = "text", pred: str = "lang_pred",
             score: str = "score", max_bytes: int = 4_000_000) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to every row, from its whole text.

    ``und`` with score 0 where the text is null, empty or has no letter (Unicode categories L; numeric signs are none). Very
    long texts are read whole, window by window. All columns pass through;
    columns that have the added names already are replaced. Nothing is shuffled; equal texts get equal results, and an
    empty table an empty one.
    """
    docs = docs.drop(pred, score)
    params, labels, at = model.p, model.labels, docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()),
                           T.StructField(score, T.DoubleType())])

    def run(batches):
        net = BiGru(params, labels)
        for b in small_batches(batches, at, max_bytes):
            texts = b.column(at).to_pylist()
            names, scores = net.predict(texts) if labels else (["und"] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, pred, score])

    return python_map(docs, run, schema)
