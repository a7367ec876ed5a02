import math
import re
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotarium.llm import language_id, quality_crf, queries, sampling


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_language_accuracy(spark, sf_dir, docs):
    got = queries.op9_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(bool(h) == held(i) for i, h in zip(got.doc_id, got.held_out))
    own = got[got.held_out & got.lang.notna()]
    assert (own.lang == own.lang_pred).mean() > 0.95


def test_language_odd(odd, none, docs):
    model = language_id.train(docs)
    got = {}
    for r in language_id.predict(odd, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all(got[i][0]["lang_pred"] == "und" and got[i][0]["score"] == 0 for i in (0, 1, 2, 14, 17))
    assert got[12][0]["lang_pred"] != "und" and len(got[None]) == 2 and not got[None][0]["held_out"]
    assert language_id.identify(none).count() == 0
    assert language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0
    assert language_id.recognised(odd, model, 0.4).columns == odd.columns


@pytest.mark.parametrize("texts", [[None], ["", None, ""], ["abc " * 75_000, ""], ["kurz", "abc " * 75_000, None, "", "abc"]])
def test_language_of_blocks_without_windows(texts):
    model = language_id.ByteCNN.fresh(["a", "b"])
    lang, score = language_id.label(model, pa.array(texts, pa.string()))
    assert [(x, s) == ("und", 0) for x, s in zip(lang, score)] == [not t for t in texts]


def test_language_of_empty_rows_alone(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else "") for i in range(600)], "doc_id long, text string").coalesce(1)
    got = language_id.predict(rows, language_id.ByteCNN.fresh(["a", "b"])).collect()
    assert len(got) == 600 and {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than the bound of the whole sample would hold at full size."""
    monkeypatch.setattr(language_id, "TEXTS", 20)
    monkeypatch.setattr(language_id, "LANGUAGES", 1)
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('l', id div 100) as lang")
    monkeypatch.setattr(language_id, "fit", lambda x, y, classes: classes)
    assert len(language_id.train(docs)) == 20


def test_sample_of_many_classes(spark):
    rows = spark.range(20_000).selectExpr("id", "id % 200 as label")
    got = [r["count"] for r in sampling.per_class(rows, "label", "id", 50, "x", 4000).groupBy("label").count().collect()]
    assert len(got) == 200 and 3500 < sum(got) < 4500 and max(got) <= 40
    null = rows.selectExpr("cast(null as long) as id", "0 as label", "id as other")
    assert sampling.per_class(null, "label", "id", 50, "x", 4000).count() <= 100


def test_ids_and_labels_are_no_inputs(docs):
    model = language_id.train(docs)
    some = docs.limit(40)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(some, model).collect()}
    b = {r["doc_id"] - 5000: (r["lang_pred"], r["score"]) for r in language_id.predict(some.withColumns({"doc_id": F.col("doc_id") + 5000, "lang": F.lit("zz"), "source": F.lit("q")}), model).collect()}
    assert a == b


def test_windows_hold_every_gram():
    for n in (0, 1, 255, 256, 257, 509, 510, 5000):
        data = np.arange(n, dtype=np.uint8)
        x, own, length = language_id.windows(data, np.array([0, n]))
        grams = {tuple(w[i : i + 4]) for w, k in zip(x, length) for i in range(k - 3)}
        assert grams >= {tuple(data[i : i + 4]) for i in range(n - 3)}
    texts = ["abc " * 50_000, "kurz", ""]
    col = pa.array(texts)
    from quotarium.llm.textnum import buffers

    model = language_id.ByteCNN.fresh(["a", "b"])
    whole = [w for w in language_id._blocks(*buffers(col), size=1 << 30)]
    parts = [w for w in language_id._blocks(*buffers(col), size=1 << 12)]
    total = lambda blocks: sum((np.bincount(o, weights=model.log_probs(x)[:, 0] * n, minlength=3) for x, o, n in blocks), np.zeros(3))
    assert np.allclose(total(whole) / 200_000, total(parts) / 200_000, atol=0.02)


def test_network_learns_two_alphabets():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(97, 105, (60, 64)), rng.integers(105, 113, (60, 64))]).astype(np.int16)
    y = np.repeat([0, 1], 60)
    m = language_id.fit(x, y, ["a", "b"], epochs=4)
    assert (m.log_probs(x).argmax(axis=1) == y).mean() == 1


def test_cnn_gradient():
    """Derivatives against differences of the loss, in double precision."""
    rng = np.random.default_rng(5)
    m = language_id.ByteCNN.fresh(["a", "b", "c"])
    m.emb, m.bias, m.out, m.out_bias, m.filters = m.emb.astype(float), m.bias + rng.normal(0, 0.1, m.bias.shape), m.out.astype(float), m.out_bias.astype(float), [f.astype(float) for f in m.filters]
    x, y = rng.integers(97, 110, (5, 40)).astype(np.int16), np.array([0, 1, 2, 1, 0])
    x[2, 30:] = 256
    _, grads = language_id.gradients(m, x, y)
    for w, g in zip([m.emb, *m.filters, m.bias, m.out, m.out_bias], grads):
        for at in rng.choice(w.size, min(25, w.size), replace=False) if w is not m.emb else range(98 * 8, 102 * 8):
            was, step = w.flat[at], 1e-6
            w.flat[at] = was + step
            up, _ = language_id.gradients(m, x, y)
            w.flat[at] = was - step
            down, _ = language_id.gradients(m, x, y)
            w.flat[at] = was
            assert abs((up - down) / (2 * step) - g.flat[at]) < 1e-5


def plain_language(m, text):
    """The network by plain loops: windows, filters, maxima, soft-max, and the mean of log-probabilities by length."""
    raw, step = text.encode(), language_id.WINDOW - 3
    starts = [0] + [a for a in range(step, len(raw), step) if len(raw) - a > 3]
    total = np.zeros(len(m.classes))
    for a in starts:
        own = list(raw[a : a + language_id.WINDOW])
        padded = own + [256] * (language_id.WINDOW + 3 - len(own))
        h = []
        for j, w in enumerate(language_id.WIDTHS):
            for f in range(language_id.FILTERS):
                best = max(sum(float(m.emb[padded[i + k], d]) * float(m.filters[j][k * language_id.DIM + d, f]) for k in range(w) for d in range(language_id.DIM)) for i in range(language_id.WINDOW))
                h.append(max(0.0, best + float(m.bias[len(h)])))
        z = [sum(x * float(m.out[i, c]) for i, x in enumerate(h)) + float(m.out_bias[c]) for c in range(len(m.classes))]
        total += len(own) * (np.array(z) - np.log(sum(np.exp(v) for v in z)))
    p = np.exp(total / len(raw))
    return m.classes[int(p.argmax())], float((p / p.sum()).max())


def test_language_by_plain_loops():
    m = language_id.ByteCNN.fresh(["a", "b", "c"])
    m.bias += np.random.default_rng(1).normal(0, 0.2, m.bias.shape).astype(np.float32)
    texts = ["kurz", "x" * 256, "Größe und Maß " * 24, "ab" * 128 + "c"]
    lang, score = language_id.label(m, pa.array(texts))
    for t, x, s in zip(texts, lang, score):
        want = plain_language(m, t)
        assert x == want[0] and abs(s - want[1]) < 1e-4


def test_quality_accuracy(spark, sf_dir, labels):
    got = queries.op7_quality_classifier(spark, sf_dir).join(labels.dropDuplicates(["doc_id"]), "doc_id").toPandas()
    assert all(bool(h) == held(i) for i, h in zip(got.doc_id, got.held_out))
    own = got[got.held_out]
    assert ((own.score >= 0.7).astype(int) == own.predicted).all() and own.score.between(0, 1).all()
    assert (own.predicted == own.quality).mean() > 0.9


def test_quality_odd(odd, none, docs, labels):
    model = quality_crf.train(docs, labels)
    got = quality_crf.predict(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (0, 1)} == {0.5}
    assert quality_crf.classify(none, labels).count() == 0
    assert {r["score"] for r in quality_crf.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_crf.good(odd, model).columns == odd.columns


def test_marginals_by_brute_force():
    """Forward-backward against the sum over all labellings."""
    rng = np.random.default_rng(3)
    m = quality_crf.LineCRF(np.zeros(3 * quality_crf.WIDTH + 1), 0.0, rng.normal(size=(2, 2)))
    scores, cuts = rng.normal(size=9), np.array([0, 4, 4, 9])
    p, pairs, log_z = m.marginals(scores, cuts)
    want, seen = np.zeros(9), np.zeros((2, 2))
    for a, z in ((0, 4), (4, 9)):
        total, mass, trans = 0.0, np.zeros(z - a), np.zeros((2, 2))
        for y in product((0, 1), repeat=z - a):
            w = np.exp(sum(s * k for s, k in zip(scores[a:z], y)) + sum(m.trans[i, j] for i, j in zip(y, y[1:])))
            total += w
            mass += w * np.array(y)
            for i, j in zip(y, y[1:]):
                trans[i, j] += w
        want[a:z] = mass / total
        seen += trans / total
    assert np.allclose(p, want) and np.allclose(pairs, seen)


def plain_levels(line):
    """Measures of one line, byte by byte and word by word, and their levels."""
    raw = line.encode()
    n = max(len(raw), 1)
    kinds = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>@^~=+_\\{}[]", "|/", "!?", ".,;:'\"-()", "\t\x0b\x0c\r "]
    out = [sum(chr(b) in k or (i == 1 and b >= 0xC3) for b in raw) / n for i, k in enumerate(kinds)]
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", line)]
    some = max(len(words), 1)
    out += [sum(words[i] == words[i - lag] for i in range(lag, len(words))) / some for lag in (1, 2, 3)]
    out += [(len(words) - len(set(words))) / some, min(len(raw) / some / 20, 1), min(math.log1p(len(words)) / 8, 1)]
    return [sum(level < np.float32(v) for level in quality_crf.LEVELS) for v in out]


def plain_score(m, text):
    """The score by plain loops over a text's lines and all their labellings."""
    lines = text.split("\n")
    if lines and not lines[-1]:
        lines.pop()
    if not lines:
        return 0.5
    levels, width, per = [plain_levels(x) for x in lines], quality_crf.WIDTH, len(quality_crf.LEVELS) + 1
    emit = []
    for t in range(len(lines)):
        e = m.bias
        for block, near in ((0, t), (1, t - 1), (2, t + 1)):
            for k in range(quality_crf.MEASURES):
                e += m.weights[block * width + k * per + levels[near][k]] if 0 <= near < len(lines) else m.weights[-1]
        emit.append(e)
    mass, total = np.zeros(len(lines)), 0.0
    for y in product((0, 1), repeat=len(lines)):
        w = math.exp(sum(e for e, k in zip(emit, y) if k) + sum(m.trans[i, j] for i, j in zip(y, y[1:])))
        total += w
        mass += w * np.array(y)
    size = np.array([len(x.encode()) + 1 for x in lines])
    return float((mass / total * size).sum() / size.sum())


def test_score_by_plain_loops(monkeypatch):
    rng = np.random.default_rng(8)
    m = quality_crf.LineCRF(rng.normal(0, 0.2, 3 * quality_crf.WIDTH + 1), 0.3, rng.normal(size=(2, 2)))
    texts = ["One line, two words.", "A a a B\n\n### $$$ 123 | x!\nGröße  und\tMaß", "", None, "\n\nx", "a b a b a b\r\nEND\n", "no newline\nnear the end\n\n\n"]
    want = [plain_score(m, t or "") for t in texts]
    for block in (quality_crf.BLOCK, 1, 9):
        monkeypatch.setattr(quality_crf, "BLOCK", block)
        assert np.allclose(quality_crf.score(m, *quality_crf.line_levels(pa.array(texts, pa.string()))), want, atol=1e-6)


def test_one_id_of_very_many_rows_is_one_sample(spark):
    docs = spark.range(3000).selectExpr("id div 1500 as doc_id", "concat('text ', id) as text")
    seen = []
    quality_crf_fit, quality_crf.fit = quality_crf.fit, lambda levels, y: seen.append(len(levels))
    try:
        quality_crf.train(docs, spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int"))
    finally:
        quality_crf.fit = quality_crf_fit
    assert seen == [sum(not held(i) for i in (0, 1))]
