"""Document quality from a linear-chain conditional random field over lines (operator 7), in numpy.

Each line is good or bad. Its features, and those of the line before and after, give the emission; a 2 x 2 matrix gives the transitions. Forward-backward gives each line's
probability to be good; their mean, weighted by the lines' lengths, is the document's score.

Only documents are labelled. Lines first take their document's label; then, in each further round, lines of a bad document that the model holds for good are relabelled, as
junk often follows clean lines.
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
from quotarium.llm.textnum import buffers, spans, word_hashes

#: Bounds of the training sample: documents of each label, lines of each document.
DOCS, LINES = 1200, 96
THRESHOLD = 0.7

_CLASS = np.zeros((8, 256), dtype=np.uint8)
_CLASS[0, 65:91] = 1
_CLASS[1, 97:123] = 1
_CLASS[1, 0xC3:] = 1
_CLASS[2, 48:58] = 1
_CLASS[3, [ord(c) for c in "#*$%&<>@^~=+_\\{}[]"]] = 1
_CLASS[4, [ord(c) for c in "|/"]] = 1
_CLASS[5, [ord(c) for c in "!?"]] = 1
_CLASS[6, [ord(c) for c in ".,;:'\"-()"]] = 1
_CLASS[7, [9, 11, 12, 13, 32]] = 1
LEVELS = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.22, 0.3, 0.4, 0.55, 0.75], dtype=np.float32)
MEASURES = 14
WIDTH = MEASURES * (len(LEVELS) + 1)
STATES = 2


#: Bytes whose lines are measured at once; a longer line is measured alone.
BLOCK = 4 << 20


def line_levels(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines of all texts: (lines, MEASURES) of levels, bytes of each line, and the n + 1 cuts between texts. Block by block, so memory follows the lines and not the bytes."""
    data, offsets = buffers(col)
    newline = np.flatnonzero(data == 10)
    starts = np.unique(np.r_[offsets[:-1][np.diff(offsets) > 0], newline + 1])
    starts = starts[starts < len(data)]
    stops = np.r_[starts[1:], len(data)] if len(starts) else starts
    cuts = np.searchsorted(starts, offsets)
    out, i = [np.zeros((0, MEASURES), np.uint8)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + BLOCK, side="right")))
        out.append(_levels(data[starts[i] : stops[j - 1]], starts[i:j] - starts[i]))
        i = j
    # a line ends before its newline, and at its text's end
    ended = np.zeros(len(starts), dtype=bool)
    ended[np.flatnonzero(stops > starts)] = data[stops[stops > starts] - 1] == 10
    return np.concatenate(out), stops - starts - ended, cuts


def _levels(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Levels of the lines that begin at the places; each ends where the next begins, with its newline if it has one."""
    stops = np.r_[starts[1:], len(data)]
    n = stops - starts - (data[stops - 1] == 10)
    size = np.maximum(n, 1).astype(np.float32)
    out = np.zeros((len(starts), MEASURES), dtype=np.float32)
    for k in range(8):  # a newline is in no class
        out[:, k] = np.add.reduceat(_CLASS[k][data], starts, dtype=np.int64) / size
    ws, we = spans(data, np.r_[starts, len(data)])
    h = word_hashes(data, ws, we)
    line = np.searchsorted(starts, ws, side="right") - 1
    words = np.bincount(line, minlength=len(starts)).astype(np.float32)
    some = np.maximum(words, 1)
    for k, lag in ((8, 1), (9, 2), (10, 3)):
        same = np.zeros(len(h), dtype=bool)
        same[lag:] = (h[lag:] == h[:-lag]) & (line[lag:] == line[:-lag])
        out[:, k] = np.bincount(line, weights=same, minlength=len(starts)) / some
    order = np.lexsort((h, line))
    again = np.zeros(len(h), dtype=bool)
    if len(h):
        again[1:] = (h[order][1:] == h[order][:-1]) & (line[order][1:] == line[order][:-1])
    out[:, 11] = np.bincount(line[order], weights=again, minlength=len(starts)) / some
    out[:, 12] = np.minimum(n / some / 20, 1)
    out[:, 13] = np.minimum(np.log1p(words) / 8, 1)
    return np.searchsorted(LEVELS, out, side="left").astype(np.uint8)


def _index(levels: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Weight numbers of each line: its own levels, those of the line before and after, with a blank at a text's ends."""
    own = levels.astype(np.int64) + np.arange(MEASURES) * (len(LEVELS) + 1)
    blank = 3 * WIDTH
    before, after = np.full_like(own, blank), np.full_like(own, blank)
    before[1:], after[:-1] = own[:-1] + WIDTH, own[1:] + 2 * WIDTH
    before[first], after[last] = blank, blank
    return np.concatenate([own, before, after], axis=1)


@dataclass
class LineCRF:
    weights: np.ndarray  # log-odds of good for each feature; the last is the ends' blank
    bias: float
    trans: np.ndarray

    def emissions(self, index: np.ndarray) -> np.ndarray:
        return self.weights[index].sum(axis=1) + self.bias

    def marginals(self, scores: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good for each line, expected transitions, and log-partition of each text; texts go side by side, line after line."""
        n = np.diff(cuts)
        p = np.zeros(len(scores))
        pairs, log_z = np.zeros((STATES, STATES)), np.zeros(len(n))
        live = np.flatnonzero(n)
        live = live[np.argsort(-n[live], kind="stable")]
        if not len(live):
            return p, pairs, log_z
        T, A = int(n[live[0]]), np.exp(self.trans)
        counts = np.searchsorted(-n[live], -np.arange(T), side="left")  # texts with more than t lines
        emit = lambda t, c: np.stack([np.ones(c), np.exp(np.clip(scores[cuts[live[:c]] + t], -30, 30))], axis=1)
        fwd, norm = [], []
        a = emit(0, int(counts[0])) / 2
        for t in range(T):
            c = int(counts[t])
            if t:
                a = (a[:c] @ A) * emit(t, c)
            z = a.sum(axis=1)
            a = a / z[:, None]
            fwd.append(a), norm.append(z)
            log_z[live[:c]] += np.log(z)
        b = np.ones((int(counts[T - 1]), STATES))
        for t in range(T - 1, -1, -1):
            c = int(counts[t])
            if len(b) < c:
                b = np.concatenate([b, np.ones((c - len(b), STATES))])
            g = fwd[t] * b
            p[cuts[live[:c]] + t] = g[:, 1] / g.sum(axis=1)
            if t:
                right = emit(t, c) * b / norm[t][:, None]
                pairs += np.einsum("ci,ij,cj->ij", fwd[t - 1][:c], A, right)
                b = right @ A.T
        return p, pairs, log_z


def fit(levels: list[np.ndarray], labels: np.ndarray, rounds: int = 2, steps: int = 60, rate: float = 0.08, decay: float = 2e-4) -> LineCRF:
    """levels: those of each document's lines; labels: 0 or 1 for each document."""
    m = LineCRF(np.zeros(3 * WIDTH + 1), 0.0, np.zeros((STATES, STATES)))
    n = np.array([len(x) for x in levels])
    cuts = np.r_[0, np.cumsum(n)]
    flat = np.concatenate(levels)
    full = n > 0
    index = _index(flat, cuts[:-1][full], cuts[1:][full] - 1)
    doc = np.repeat(np.arange(len(n)), n)
    # both labels weigh alike
    y = labels[doc].astype(float)
    share = np.array([(labels == k).mean() for k in (0, 1)])
    weight = (0.5 / np.maximum(share, 1e-9))[labels][doc]
    for turn in range(rounds):
        if turn:
            p, _, _ = m.marginals(m.emissions(index), cuts)
            worst = np.full(len(n), 2.0)
            np.minimum.at(worst, doc, p)
            y = np.where((labels[doc] == 0) & (p > 0.6) & (p > worst[doc]), 1.0, labels[doc].astype(float))
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        seen = np.zeros((STATES, STATES))
        np.add.at(seen, (y[inner].astype(int), y[inner + 1].astype(int)), 1)
        g1, g2 = [np.zeros_like(m.weights), 0.0, np.zeros((2, 2))], [np.zeros_like(m.weights), 0.0, np.zeros((2, 2))]
        for t in range(1, steps + 1):
            p, pairs, _ = m.marginals(m.emissions(index), cuts)
            err = (p - y) * weight / len(y)
            gw = np.bincount(index.ravel(), weights=np.repeat(err, index.shape[1]), minlength=len(m.weights)) + decay * m.weights
            grads = [gw, err.sum(), (pairs - seen) / max(1, len(inner)) + 0.05 * m.trans]
            new = []
            for i, (w, g) in enumerate(zip((m.weights, m.bias, m.trans), grads)):
                g1[i] = 0.9 * g1[i] + 0.1 * g
                g2[i] = 0.99 * g2[i] + 0.01 * g * g
                new.append(w - rate * (g1[i] / (1 - 0.9**t)) / (np.sqrt(g2[i] / (1 - 0.99**t)) + 1e-9))
            m.weights, m.bias, m.trans = new[0], float(new[1]), np.clip(new[2], -2.5, 2.5)
    return m


def score(model: LineCRF, levels: np.ndarray, size: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Score of each document: marginals weighted by the lines' lengths (an empty line counts as one byte); 0.5 without lines."""
    n = np.diff(cuts)
    full = n > 0
    index = _index(levels, cuts[:-1][full], cuts[1:][full] - 1)
    p, _, _ = model.marginals(model.emissions(index) if len(index) else np.zeros(0), cuts)
    w = size + 1.0
    top, low = np.r_[0, np.cumsum(p * w)], np.r_[0, np.cumsum(w)]
    return np.where(full, np.clip((top[cuts[1:]] - top[cuts[:-1]]) / np.maximum(low[cuts[1:]] - low[cuts[:-1]], 1e-9), 0, 1), 0.5)


def train(docs: DataFrame, labels: DataFrame) -> LineCRF:
    """Learns from a bounded sample: at most about DOCS documents of each quality, the lines of each from a hashed place on, LINES at most. Held-out ids are left out; of rows that repeat an id one counts."""
    small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).dropDuplicates(["doc_id"])
    some = F.broadcast(per_class(marks, "quality", "doc_id", DOCS, "quality"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(some, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            levels, _, cuts = line_levels(b["text"])
            out = []
            for d, i, j in zip(b["doc_id"].to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                i += (d * 7919) % max(1, j - i - LINES + 1)
                out.append(levels[i : min(j, i + LINES)].tobytes())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["quality"], pa.array(out, pa.binary())], names=["doc_id", "quality", "levels"])

    some = rows.mapInArrow(run, "doc_id long, quality int, levels binary").groupBy("doc_id", "quality").agg(F.min("levels").alias("levels"))
    got = sorted(some.collect(), key=lambda r: (r["doc_id"], r["quality"], r["levels"]))
    if not got:
        return LineCRF(np.zeros(3 * WIDTH + 1), 0.0, np.zeros((STATES, STATES)))
    return fit([np.frombuffer(r["levels"], dtype=np.uint8).reshape(-1, MEASURES) for r in got], np.array([r["quality"] for r in got]))


def predict(docs: DataFrame, model: LineCRF, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, over its whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score(model, *line_levels(b["text"]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good(docs: DataFrame, model: LineCRF, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(score(model, *line_levels(b["text"])) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on labelled rows that aren't held out, then scores every row.

    A null or empty text has no lines and scores 0.5; without labels every score is 0.5. Repeated rows score alike; a null doc_id isn't held out and has no label. A text of any length
    is scored by all its lines. An empty table gives no rows; only doc_id and text are read, so other columns can't clash.
    """
    return predict(docs, train(docs, labels))
