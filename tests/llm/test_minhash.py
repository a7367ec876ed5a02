import random
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences

from quotarium.llm import minhash, queries
from quotarium.llm.textnum import shingle_sets


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, words, percent):
    """Size and component of each row from all pairs. Ids may repeat: then they are one place."""
    sets = [shingles(t, words) for _, t in rows]
    par = {i: i for i, _ in rows}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(rows[a][0]), find(rows[b][0])
                    par[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


def rows_of(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_documents(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = queries.op6_minhash(spark, sf_dir)
    assert rows_of(got) == brute(rows, 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


@pytest.mark.parametrize("seed, base", [(0, True), (1, False), (2, True)])
def test_families(spark, seed, base):
    """Copies with more and more words changed, with and without the text they come from, copies of copies, and cut copies: links must be those of all pairs."""
    rng = random.Random(seed)
    rows, n = [], 0
    for family in range(4):
        words = [f"f{family}w{rng.randrange(400)}" for _ in range(150)]
        own = [words] if base else []
        for k in range(40):
            w = list(rng.choice(own) if own and family % 2 else words)
            for _ in range(rng.randrange(14)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
            own.append(w[: rng.randrange(60, 151)] if family == 3 else w)
        rows += [(n := n + 1, " ".join(w)) for w in own]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(minhash.near_duplicates(df, 3, 85)) == brute(rows, 3, 85)


@pytest.mark.parametrize("left, rows", [(0, 1024), (90, 3)])
def test_few_and_many_rounds(spark, monkeypatch, left, rows):
    """However early or late pairs are compared, and however many keys are dealt over tasks, links are the same."""
    monkeypatch.setattr(minhash, "LEFT", left)
    monkeypatch.setattr(minhash, "LEAST_PAIRS", 0)
    monkeypatch.setattr(minhash, "PAIRS", 0)
    monkeypatch.setattr("quotarium.llm.common.HOT_ROWS", rows)
    if rows < 10:
        monkeypatch.setattr("quotarium.llm.common.fits", lambda *a: False)
    test_families(spark, 3, True)


def test_sets_and_signatures():
    texts = ["A b C d", "a B c D", "one two", "", None, " ", "x " * 5000, "é😀 ß ü"]
    sets = shingle_sets(pa.array(texts, pa.string()), 3)
    assert [len(s) for s in sets] == [len(shingles(t, 3)) for t in texts]
    assert (sets[0] == sets[1]).all()
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    b = np.unique(np.r_[a[:3400], rng.integers(0, 2**63, 600).astype(np.uint64)])
    sig = minhash.signature([a, b])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.14
    assert (minhash.signature([a], block=64) == sig[:1]).all()


def test_odd(odd, none):
    got = minhash.near_duplicates(odd)
    assert got.count() == odd.count()
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r["component_id"])
    assert by[0] == [0] and by[1] == [1] and by[2] == [2] and by[6] == [-7] and by[7] == [-7] and by[8] == [-7] and by[11] == [10] and set(by[5]) <= {-7, 5}
    assert minhash.near_duplicates(none).count() == 0


def test_like_sql(spark, sf_dir):
    assert differences(queries.op6_minhash(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op6_minhash"]) is None


def test_one_letter_words_and_ties(spark):
    rows = [(i, " ".join("ab"[i >> k & 1] for k in range(6))) for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(df, 3, 85)) == brute(rows, 3, 85)
