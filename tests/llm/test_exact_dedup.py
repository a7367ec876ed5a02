import hashlib
from collections import defaultdict

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from quotarium.llm import exact_dedup, queries


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        g = groups[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_like_sql(spark, sf_dir):
    assert differences(queries.op3_exact_dedup(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op3_exact_dedup"]) is None


@pytest.mark.parametrize("digest", [exact_dedup.sha, lambda t: F.substring(exact_dedup.sha(t), 1, 1)], ids=["sha256", "colliding"])
def test_like_brute_force(odd, none, digest):
    """With a digest of four bits nearly all hits are collisions, which the bytes must tell apart."""
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(odd, digest).collect()), key=repr)
    assert got == brute([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()])
    assert exact_dedup.exact_dedup(none, digest).count() == 0


def test_state_lives_on(spark, tmp_path):
    """A second call reads only what is new, and new copies meet the state of old rows."""
    path, schema = str(tmp_path / "in"), "doc_id long, text string"
    spark.createDataFrame([(1, "Same"), (2, "own")], schema).write.parquet(path)
    first, state = exact_dedup.stream_keys(spark, path, schema, exact_dedup.sha)
    assert first.count() == 2
    spark.createDataFrame([(9, "SAME")], schema).write.mode("append").parquet(path)
    second, _ = exact_dedup.stream_keys(spark, path, schema, exact_dedup.sha, state)
    rows = second.collect()
    assert [(r["keep_id"], r["group_size"]) for r in rows] == [(9, 2)] and rows[0]["locator"].endswith(".parquet")


def test_files_meet_an_older_state(spark, tmp_path):
    path, schema = str(tmp_path / "in") + "/", "doc_id long, text string"
    spark.createDataFrame([(1, "Same"), (2, "own")], schema).coalesce(1).write.parquet(path)
    _, state = exact_dedup.stream_keys(spark, path, schema, exact_dedup.sha)
    spark.createDataFrame([(9, "SAME"), (4, "own"), (5, "new")], schema).coalesce(1).write.mode("append").parquet(path)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup_files(spark, path, schema, state=state).collect()}
    assert got == {1: (9, 2, False), 2: (4, 2, False), 9: (9, 2, True), 4: (4, 2, True), 5: (5, 1, True)}


def test_a_frequent_text_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quotarium.llm.common.HOT_ROWS", 5)
    monkeypatch.setattr("quotarium.llm.common.fits", lambda *a: False)
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(200)] + [(300, "Copy"), (301, None), (302, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "in"))
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(spark.read.parquet(str(tmp_path / "in"))).collect()), key=repr)
    assert got == brute(rows)
