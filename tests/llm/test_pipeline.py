"""Each stage of the pipeline against what it is to do with its own input, and the whole run."""

import corpus_pipeline as cp
import pyarrow as pa
import pytest
from llm_brute import exact as exact_brute
from llm_brute import near as near_brute

from quotarium.llm import language_id, packing, quality_crf, queries


@pytest.fixture(scope="module")
def stages(spark, sf_dir, docs, tmp_path_factory):
    """(name, input, output) of each stage."""
    out, df = [], docs
    for name, f in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, df, sf_dir).write.parquet(path)
        new = spark.read.parquet(path)
        out.append((name, df, new))
        df = new
    return {n: (a, b) for n, a, b in out}


def test_columns(stages, docs):
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.schema.names == docs.schema.names, name
    assert len(cp.STAGES) == 5 and set(stages["packing"][1].columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_language(stages, docs):
    before, after = stages["language"]
    judged = {r["doc_id"] for r in language_id.predict(before, language_id.train(before)).filter(f"lang_pred <> 'und' and score >= {cp.LEAST_LANGUAGE}").collect()}
    assert {r["doc_id"] for r in after.collect()} == judged and len(judged) > 0.9 * before.count()


def test_quality(stages, labels):
    before, after = stages["quality"]
    judged = {r["doc_id"] for r in quality_crf.predict(before, quality_crf.train(before, labels)).filter("predicted = 1").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    assert kept == judged
    good = {r["doc_id"] for r in labels.filter("quality = 1").join(before, "doc_id", "left_semi").collect()}
    assert len(good & kept) > 0.95 * len(good)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_exact(stages):
    before, after = stages["exact_dedup"]
    assert sorted(i for i, _ in rows(after)) == sorted(r[0] for r in exact_brute(rows(before)) if r[3])


def test_near(stages):
    before, after = stages["near_dedup"]
    assert sorted(i for i, _ in rows(after)) == sorted(i for i, _, c in near_brute(rows(before), 5, 80) if i == c)


def test_packing(stages):
    before, after = stages["packing"]
    whole = packing.pieces(before, queries.tokenizer("word_bpe_49k.json"), 2048)
    assert sorted(map(tuple, after.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_run(spark, sf_dir, stages):
    got = cp.run(spark, sf_dir)
    assert got.count() == stages["packing"][1].count()


def test_exact_stage_tells_rows_of_one_id_apart(spark, sf_dir):
    df = spark.createDataFrame([(1, "a"), (2, "A"), (2, "b"), (None, "b"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in cp.without_copies(spark, df, sf_dir).collect()), key=repr)
    assert got == sorted([(2, "A"), (2, "b"), (4, "")], key=repr)


def test_near_stage_tells_rows_apart(spark, sf_dir):
    """Rows of one doc_id are judged by their own texts, and rows without a doc_id are judged at all."""
    text = lambda c: " ".join(f"{c}{i}" for i in range(120))
    rows = [(1, text("a")), (2, text("a") + " end"), (2, text("b")), (None, text("a") + " more"), (None, text("c")), (None, text("c") + " end"), (3, text("b") + " end"), (4, None)]
    got = [(r["doc_id"], r["text"]) for r in cp.without_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()]
    kept = {(1, text("a")), (2, text("b")), (4, None)}
    assert kept < set(got) and len(got) == 4 and (set(got) - kept) < {(None, text("c")), (None, text("c") + " end")}


def test_no_rows(spark, sf_dir, none):
    df = none
    for name, f in cp.STAGES:
        df = f(spark, df, sf_dir)
        assert df.count() == 0, name


def kept_rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_odd_rows_through_every_stage(spark, sf_dir, docs, labels, odd):
    """Nulls, empty and very long texts, repeated rows and ids, and clashing columns, against what each stage says it does with them."""
    whole = kept_rows(odd)
    lang = language_id.train(docs)
    scores = [(t, *x) for (_, t), x in zip(whole, zip(*language_id.label(lang, pa.array([t for _, t in whole], pa.string()))))]
    got = cp.language_id.recognised(odd, lang, cp.LEAST_LANGUAGE)
    assert got.columns == odd.columns and kept_rows(got) == [r for r, (_, x, s) in zip(whole, scores) if x != "und" and s >= cp.LEAST_LANGUAGE]
    quality = quality_crf.train(docs, labels)
    marks = quality_crf.score(quality, *quality_crf.line_levels(pa.array([t for _, t in whole], pa.string())))
    got = quality_crf.good(odd, quality)
    assert got.columns == odd.columns and kept_rows(got) == [r for r, s in zip(whole, marks) if s >= quality_crf.THRESHOLD]
    got = cp.without_copies(spark, odd, sf_dir)
    alive = exact_brute(whole)
    assert got.columns == odd.columns and sorted(r["doc_id"] is None or r["doc_id"] for r in got.collect()) == sorted(r[0] is None or r[0] for r in alive if r[3])
    # rows of one id and text can't be told apart, so any of them may stay
    got = cp.without_near_copies(spark, odd, sf_dir)
    order = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))
    judged = near_brute([(i, r["text"]) for i, r in enumerate(order)], 5, 80)
    assert got.columns == odd.columns and got.count() == sum(i == c for i, _, c in judged)
    assert {r["doc_id"] for r in got.collect()} >= {0, 1, 2, 3, 4, 12, 17}
    got = cp.packed(spark, odd, sf_dir)
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == {i for i, _ in whole}


def test_run_leaves_only_its_result(spark, sf_dir):
    from quotarium import storage

    storage.release(spark)
    rows = cp.run(spark, sf_dir).count()
    left = storage._all[spark.sparkContext.applicationId]
    assert rows and len(left) == 1 and "stage-packing" in left[0]
