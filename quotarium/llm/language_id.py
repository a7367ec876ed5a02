"""Language identification by a byte convolutional network (operator 9), trained and applied in numpy.

Bytes are embedded; filters of several widths slide over fixed-length windows; each filter's maximum over the window goes to a softmax over the
languages. A text is read in windows that overlap by the widest filter less one byte, so that every n-gram lies in one; the windows' log-probabilities are averaged by their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotarium.llm.common import held_out, small_batches
from quotarium.llm.sampling import per_class
from quotarium.llm.textnum import buffers

WIDTHS, FILTERS, DIM, WINDOW = (2, 3, 4), 12, 8, 256
#: Bounds of the training sample: texts of each language, windows of each text; with more than twice as many languages, each has fewer texts.
TEXTS, WINDOWS, LANGUAGES = 300, 3, 64


@dataclass
class ByteCNN:
    emb: np.ndarray  # (257, DIM); row 256 pads and stays 0
    filters: list[np.ndarray]  # (width * DIM, FILTERS) each
    bias: np.ndarray
    out: np.ndarray  # (features, classes)
    out_bias: np.ndarray
    classes: list[str]

    @classmethod
    def fresh(cls, classes: list[str], seed: int = 7) -> ByteCNN:
        r = np.random.default_rng(seed)
        emb = r.normal(0, 0.5, (257, DIM)).astype(np.float32)
        emb[256] = 0
        n = FILTERS * len(WIDTHS)
        return cls(emb, [r.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(n, np.float32), r.normal(0, 0.1, (n, len(classes))).astype(np.float32), np.zeros(len(classes), np.float32), classes)

    def stacked(self) -> np.ndarray:
        """All filters as one matrix over the widest window; narrow ones end in zeros."""
        w = max(WIDTHS) * DIM
        return np.concatenate([np.pad(f, ((0, w - len(f)), (0, 0))) for f in self.filters], axis=1)

    def pooled(self, x: np.ndarray, where: bool = False):
        """x: (windows, WINDOW) of byte codes. Maximum of each filter, and its place."""
        wide = max(WIDTHS)
        e = np.ascontiguousarray(self.emb[np.pad(x, ((0, 0), (0, wide - 1)), constant_values=256)].reshape(len(x), -1))
        view = np.lib.stride_tricks.as_strided(e, (len(x), x.shape[1], wide * DIM), (e.strides[0], DIM * e.itemsize, e.itemsize))
        z = view.reshape(-1, wide * DIM) @ self.stacked()
        z = z.reshape(len(x), x.shape[1], -1)
        at = z.argmax(axis=1) if where else None
        m = np.maximum((np.take_along_axis(z, at[:, None], 1)[:, 0] if where else z.max(axis=1)) + self.bias, 0)
        return (m, at, view) if where else m

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        if not len(x):  # a block of null and empty texts
            return np.zeros((0, len(self.classes)), np.float32)
        z = np.concatenate([self.pooled(x[i : i + 64]) for i in range(0, len(x), 64)]) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def gradients(m: ByteCNN, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of some windows, and its derivatives by emb, filters, bias, out and out_bias."""
    wide = max(WIDTHS)
    h, at, view = m.pooled(x, where=True)
    z = h @ m.out + m.out_bias
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    loss = float(-np.log(p[np.arange(len(y)), y]).mean())
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    dh = (p @ m.out.T) * (h > 0)
    row = np.arange(len(x))[:, None]
    dw = np.einsum("bf,bfk->kf", dh, view[row, at])
    demb = np.zeros_like(m.emb)
    padded = np.pad(x, ((0, 0), (0, wide - 1)), constant_values=256)
    back = dh[:, :, None] * m.stacked().T[None]
    for k in range(wide):
        np.add.at(demb, padded[row, at + k].ravel(), back[:, :, k * DIM : (k + 1) * DIM].reshape(-1, DIM))
    demb[256] = 0
    return loss, [demb, *[dw[: w * DIM, j * FILTERS : (j + 1) * FILTERS] for j, w in enumerate(WIDTHS)], dh.sum(axis=0), h.T @ p, p.sum(axis=0)]


def fit(x: np.ndarray, y: np.ndarray, classes: list[str], epochs: int = 12, batch: int = 64, rate: float = 4e-3) -> ByteCNN:
    m = ByteCNN.fresh(classes)
    r = np.random.default_rng(11)
    params = [m.emb, *m.filters, m.bias, m.out, m.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for i in range(0, len(x), batch):
            _, grads = gradients(m, x[order[i : i + batch]], y[order[i : i + batch]])
            t += 1
            for w, g, a, b in zip(params, grads, first, second):
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                w -= (rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return m


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte windows of all texts (padded with 256), the text of each and its number of bytes."""
    step = WINDOW - max(WIDTHS) + 1
    size = np.diff(offsets)
    n = np.where(size > 0, np.maximum(1, -(-(size - (WINDOW - step)) // step)), 0)
    own = np.repeat(np.arange(len(n)), n)
    start = offsets[own] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step
    length = np.minimum(offsets[own + 1] - start, WINDOW)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    x = np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16) if len(data) else np.int16(0), np.int16(256))
    return x, own, length


def train(docs: DataFrame) -> ByteCNN:
    """Learns from windows of a bounded sample: at most about TEXTS texts of each language, fewer if there are very many languages, and WINDOWS windows of each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    some = per_class(rows, "lang", "doc_id", TEXTS, "language", 2 * TEXTS * LANGUAGES)
    at = lambda k: F.substring("text", 1 + F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))).cast("int"), F.lit(WINDOW))
    got = some.select("doc_id", "lang", *[at(k).alias(f"w{k}") for k in range(WINDOWS)]).collect()
    got.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["lang"]))
    classes = sorted({r["lang"] for r in got})
    raw = [(r[f"w{k}"].encode()[:WINDOW], classes.index(r["lang"])) for r in got for k in range(WINDOWS)]
    x = np.full((len(raw), WINDOW), 256, dtype=np.int16)
    for i, (b, _) in enumerate(raw):
        x[i, : len(b)] = np.frombuffer(b, dtype=np.uint8)
    return fit(x, np.array([k for _, k in raw], dtype=np.int64), classes)


def label(model: ByteCNN, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    data, offsets = buffers(texts)
    k = len(model.classes)
    total = np.zeros((len(texts), max(k, 1)))
    if k:
        # block by block: memory doesn't follow a long text
        for x, own, length in _blocks(data, offsets):
            np.add.at(total, own, model.log_probs(x) * length[:, None])
    z = total / np.maximum(np.diff(offsets), 1)[:, None]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    no = [t is None or not any(map(str.isalpha, t)) or not k for t in texts.to_pylist()]
    return ["und" if u else model.classes[i] for u, i in zip(no, best)], [0.0 if u else float(p[j, i]) for j, (u, i) in enumerate(zip(no, best))]


def recognised(docs: DataFrame, model: ByteCNN, least: float) -> DataFrame:
    """The rows, with all their columns, whose text has a language with at least this score."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = label(model, b["text"])
            yield b.filter(pa.array([x != "und" and s >= least for x, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, over its whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = label(model, b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def _blocks(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 18) -> Iterator[tuple]:
    """windows(), about `size` bytes at a time."""
    step = WINDOW - max(WIDTHS) + 1
    cut = size // step * step
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        if j == i + 1 and offsets[j] - offsets[i] > size:
            for a in range(int(offsets[i]), int(offsets[j]), cut):
                end = min(a + cut + WINDOW - step, int(offsets[j]))
                if a > offsets[i] and end - a <= WINDOW - step:
                    break
                x, own, n = windows(data[a:end], np.array([0, end - a]))
                yield x, own + i, n
        else:
            x, own, n = windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield x, own + i, n
        i = j


def identify(docs: DataFrame) -> DataFrame:
    """Trains on the rows with a language that aren't held out, then predicts every row.

    lang_pred is und, with score 0, if the text is null or has no letter, or if there is nothing to learn from. Repeated rows are predicted alike; a null doc_id isn't held
    out. Of a text of any length all windows count. An empty table gives no rows; only doc_id, text and, to learn, lang are read, so other columns can't clash.
    """
    return predict(docs, train(docs))
