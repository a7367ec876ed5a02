from collections import Counter

from compare import connect, differences
from pyspark.sql import functions as F

from quotarium.llm import quality_rules, queries


def test_like_sql(spark, sf_dir):
    con = connect(sf_dir)
    assert differences(queries.op2_quality_rules(spark, sf_dir), con, queries.oracle_sql()["op2_quality_rules"]) is None


def test_base_by_hand(spark):
    import re

    texts = ["a b c a b c", "x y z w x y z", "one two", None, "", "A#B *$%&|<>\nA#B *$%&|<>\n\n \t\n", "q " * 200, "ß é 😀 ß é 😀"]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame([(i, t, "l", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(grams)
        again = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_repeats_behind_two_million_words(spark):
    """A run of 1002 words that stands twice, both times behind word 2^21."""
    words = F.concat(F.sequence(F.lit(0), F.lit(2_098_499)), F.sequence(F.lit(2_097_300), F.lit(2_098_301)))
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit("l").alias("lang"), F.lit("s").alias("source"), F.array_join(words.cast("array<string>"), " ").alias("text"))
    r = quality_rules.measured(docs).first()
    assert (r["n_words"], r["n_repeat_words"]) == (2_099_502, 2004)


def test_odd(odd, none):
    got = quality_rules.quality_rules(odd)
    assert got.count() == odd.count() and got.filter("kept and base_failed").count() == 0
    assert quality_rules.quality_rules(none).count() == 0


def test_clean_documents_stay(spark, sf_dir, labels):
    got = queries.op2_quality_rules(spark, sf_dir).join(labels.dropDuplicates(["doc_id"]), "doc_id").filter("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97


def test_large_groups_are_dealt_over_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(quality_rules, "HOT_ROWS", 5)
    monkeypatch.setattr("quotarium.llm.common.fits", lambda *a: False)
    assert differences(queries.op2_quality_rules(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op2_quality_rules"]) is None


def test_native(spark, sf_dir, monkeypatch):
    """No step's plan has Python in it, nor the last one's."""
    plans, write = [], quality_rules.written

    def seen(df, what):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, what)

    monkeypatch.setattr(quality_rules, "written", seen)
    plans.append(queries.op2_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and not any(x in plan for plan in plans for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
