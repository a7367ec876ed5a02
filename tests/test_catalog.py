"""Every query of the catalog against its SQL, and plans that must stay as they are."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from quotarium.plans import catalog


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLES:
        assert differences(df, duck, catalog.ORACLES[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_only_two_rungs_stay_in_the_jvm(spark, sf_dir):
    plan = catalog.verify_exact(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "_fuzzy" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "_fuzzy" in catalog.verify_ladder(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["token_window_usage", "token_estimate_last5", "rate_limit_admission"])
def test_no_window_is_summed_anew_for_each_row(spark, sf_dir, name):
    assert "RangeFrame" not in catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_used_tokens_meet_in_one_shuffle(spark, sf_dir):
    """What is used needs no last sizes: no join, and no window over a lane's spans, which is a task for each lane."""
    run = catalog.token_window_usage(spark, sf_dir)._jdf.queryExecution()
    assert "Join" not in run.optimizedPlan().toString() and run.executedPlan().toString().count("Exchange ") == 1


@pytest.mark.parametrize("name", ["no_text_layer_docs", "page_offsets", "page_lookup", "boilerplate_stripped_text"])
def test_texts_are_assembled_once(spark, sf_dir, name):
    """Filters on an assembled text don't assemble it in a second Python worker of each task."""
    assert catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_fuzzy_verdicts_by_brute_force(spark, sf_dir):
    """Scores of the fuzzy rung against the windows of a plain dynamic program, on short documents."""
    from test_functions import brute

    from quotarium.operators import ladder
    from quotarium.plans import derived as d

    docs = d.doc_texts(spark, sf_dir).filter("has_text_layer and length(full_cf) < 400")
    found = d.findings(spark, sf_dir, "fuzzy").join(docs.select("filename"), "filename", "left_semi")
    texts = {r["filename"]: r["full_cf"] for r in docs.collect()}
    rows = ladder.verify(found, docs).orderBy("finding_ord").limit(6).collect()
    assert rows
    from quotarium.functions.text import normalize_text

    for r in rows:
        needle, text = normalize_text(r["snippet"], True), texts[r["filename"]]
        if needle not in text and len(needle) < len(text):
            assert abs(r["match_score"] - brute(needle, text)[0]) < 1e-9
