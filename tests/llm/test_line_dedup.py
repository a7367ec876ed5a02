import hashlib
import random
import re

import numpy as np
import pytest
from compare import connect, differences

from quotarium.llm import line_dedup, queries

WORD = r"[^\x20\x09-\x0D]+"


def brute_words(rows, run=50):
    """Words that are kept: those in no run of words that stood before."""
    first, kept = {}, []
    for at, (doc, text) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        words, drop = re.findall(WORD, text or ""), set()
        for i in range(len(words) - run + 1):
            if first.setdefault(tuple(words[i : i + run]), (at, i)) != (at, i):
                drop.update(range(i, i + run))
        kept.append((doc, [x for i, x in enumerate(words) if i not in drop]))
    return kept


def words_left(df):
    return sorted(((r["doc_id"], re.findall(WORD, r["text"])) for r in df.collect()), key=repr)


def test_passage_inside_lines(spark, tmp_path):
    """A passage inside longer lines of different text goes from the later document, and only there."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one two {passage} three\nlast"), (2, f"first\nfour {passage} five six"), (3, f"seven\n{passage}\n\neight  nine"), (4, f"ten\n{passage[:120]}")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["text_sha256"], r["n_lines"], r["n_removed_lines"]) for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()}
    want = [(1, rows[0][1], 2, 0), (2, "first\nfour five six", 2, 0), (3, "seven\n\neight  nine", 4, 1), (4, rows[3][1], 2, 0)]
    assert got == {i: (hashlib.sha256(t.encode()).hexdigest(), n, k) for i, t, n, k in want}


@pytest.mark.parametrize("seed", range(2))
def test_passages_like_brute_force(spark, seed):
    """Passages cut at any word, with first copies in different documents, and repeats inside one document."""
    rng = random.Random(seed)
    long_ = [f"w{rng.randrange(400)}" for _ in range(600)] + ["q"] * 130
    rows = []
    for i in range(50):
        words = []
        for _ in range(rng.randrange(5)):
            a = rng.randrange(len(long_))
            words += long_[a : a + rng.randrange(30, 200)] + [f"own{i}"] * rng.randrange(2)
        rows.append((i, "".join(w + rng.choice("  \n") for w in words)))
    got = line_dedup.passage_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert words_left(got) == sorted(brute_words(rows), key=repr)


def test_passages_on_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert words_left(line_dedup.passage_dedup(docs)) == sorted(brute_words(rows), key=repr)


def test_like_sql(spark, sf_dir):
    assert differences(queries.op1_line_dedup(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op1_line_dedup"]) is None


def test_passages_odd(odd, none):
    got = line_dedup.passage_dedup(odd)
    assert got.count() == odd.count() and got.columns == ["doc_id", "text", "n_lines", "n_removed_lines"]
    assert {r["doc_id"]: r["n_removed_lines"] for r in got.collect()}[11] == 1500
    assert line_dedup.passage_dedup(none).count() == 0


def test_a_frequent_passage_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr("quotarium.llm.common.HOT_ROWS", 4)
    monkeypatch.setattr("quotarium.llm.common.fits", lambda *a: False)
    test_passages_like_brute_force(spark, 3)


def test_copies_of_a_window_select_the_same_gram():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 2**63, 400).astype(np.uint64)
    h[240:320] = h[40:120]
    (_, best, value, whole, _), = line_dedup.word_windows(h)
    assert (whole[240:271] == whole[40:71]).all() and (value[240:271] == value[40:71]).all() and (best[240:271] - 200 == best[40:71]).all()


def test_blocks_make_no_difference():
    h = np.random.default_rng(2).integers(1, 2**63, 700).astype(np.uint64)
    whole = np.concatenate([w[3] for w in line_dedup.word_windows(h)])
    parts = np.concatenate([w[3] for w in line_dedup.word_windows(h, block=64)])
    assert (whole == parts).all() and len(whole) == 651
