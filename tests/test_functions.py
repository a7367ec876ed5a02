"""Normalisation, identifiers, alignment and answers against plain Python."""

import hashlib
import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotarium.functions import ids
from quotarium.functions.alignment import partial_alignment, partial_alignments, unfolded
from quotarium.functions.answers import clean_json_text, decode
from quotarium.functions.pages import assemble
from quotarium.functions.text import fragments, normalize, normalize_text, signature, split_fragments, strip

ODD = "a-B_\n\t \x0b\x1c\x85\u00a0\u2007\u3000\u200b\ufeff\u00ad\u2018\u2033\u2014\u2026\ufb01\u00df\u1e9e\u00e9\u00e99\u0663"


def slow_normal(text, fold=False):
    """Character by character, as the rules are written down."""
    out = unicodedata.normalize("NFKC", text or "")
    for group, to in (("\u2018\u2019\u201a\u201b\u2032", "'"), ("\u201c\u201d\u201e\u201f\u2033", '"'), ("\u2010\u2011\u2012\u2013\u2014\u2015\u2212", "-"), ("\u2026", "..."), ("\u00a0\u2007\u202f\u2009\u200a", " "), ("\u200b\u200c\u200d\ufeff\u00ad", "")):
        out = "".join(to if c in group else c for c in out)
    out = re.sub(r"(\w)-[ \t]*\n[ \t]*(\w)", r"\1\2", out)
    out = re.sub(r"\s+", " ", out).strip()
    return out.casefold() if fold else out


@pytest.mark.parametrize("raw, want", [("inno-\nvation", "innovation"), ("e\ufb03cient", "efficient"), ("\u201cit\u2019s\u201d", "\"it's\""), ("a \u2014 b", "a - b"), ("a\u00a0b", "a b"), (None, ""), ("  \n ", ""), ("well-known", "well-known"), ("co\u00ad\nop", "co op"), ("a\u2033", "a''"), ("x-\ny-\nz", "xy- z")])
def test_normal_form(raw, want):
    assert normalize_text(raw) == want == slow_normal(raw)


@given(st.text(st.sampled_from(ODD), max_size=40), st.booleans())
@settings(max_examples=300, deadline=None)
def test_normal_form_of_anything(text, fold):
    assert normalize_text(text, fold) == slow_normal(text, fold)


def test_normal_form_in_spark(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(30))) for _ in range(300)] + ["".join(rng.choices("aB-9_\n\t \x0b\x1c\x1f", k=20)) for _ in range(300)] + [None, "", "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", normalize(F.col("t")).alias("n"), normalize(F.col("t"), fold=True).alias("f"), signature(F.col("t")).alias("s"), strip(F.col("t")).alias("p"))
    for r in df.collect():
        t = texts[r["i"]]
        assert (r["n"], r["f"]) == (slow_normal(t), slow_normal(t, True))
        assert r["s"] == re.sub(r"\d+", "#", slow_normal(t, True)).strip(" ")
        assert r["p"] == (None if t is None else t.strip())


def test_fragments(spark):
    cases = ["one two ... three", "only one ...", "a . . . b [...] c", "with the one sign \u2026 it stays whole", "four.... dots", "", None, "... lead"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(cases)), "i int, t string").orderBy("i").select(fragments(F.col("t"))).collect()]
    assert got == [["one two", "three"], None, ["a", "b", "c"], None, ["four", ". dots"], None, None, None]
    assert split_fragments("...") == []


def test_identifiers(spark):
    rows = [("\u00d6l & Gas (v1.2).final.pdf", "V O: costs/benefits", 12345), (".hidden", "__x__", 7), ("a" * 80 + ".pdf", "c" * 50, 1)]
    df = spark.createDataFrame(rows, "f string, c string, n long").select(ids.custom_id(F.col("f"), F.col("n")), ids.snippet_id(F.col("f"), F.col("c"), F.col("n")), ids.finding_hash(F.col("f"), F.col("c"), F.lit("K"), F.lit("\u00fc")))
    for (f, c, n), r in zip(rows, df.collect()):
        clean = lambda x: re.sub("[^A-Za-z0-9_-]", "_", x)
        stem = f[: f.rindex(".")] if f.rfind(".") > 0 else f
        assert r[0] == f"req-{n:04d}-{clean(f)}"[:64]
        assert r[1] == f"{clean(stem)[:40].strip('_')}__{clean(c)[:30].strip('_')}__{n:04d}"
        assert r[2] == hashlib.sha256(f"{f}|{c}|K|\u00fc".encode()).hexdigest()[:16]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute(needle, text):
    """All windows in order; the first best counts."""
    n, m = len(needle), len(text)
    wins = [(0, p) for p in range(1, n)] + [(i, i + n) for i in range(m - n + 1)] + [(m - p, m) for p in range(n - 1, 0, -1)]
    best = (0.0, 0, n)
    for a, z in wins:
        if (s := 200.0 * lcs(needle, text[a:z]) / (n + z - a)) > best[0]:
            best = (s, a, z)
    return best


@given(st.text("abc ", min_size=1, max_size=9), st.text("abc ", min_size=1, max_size=40))
@settings(max_examples=400, deadline=None)
def test_alignment_is_the_best_of_all_windows(needle, text):
    if len(needle) >= len(text):
        needle, text = text[:-1] or "a", text + needle
    got, want = partial_alignment(needle, text), brute(needle, text)
    assert abs(got.score - want[0]) < 1e-9
    assert abs(200.0 * lcs(needle, text[got.start : got.end]) / (len(needle) + got.end - got.start) - want[0]) < 1e-9
    if want[0] > 0:
        assert (got.start, got.end) == want[1:]


PAIRS = st.tuples(st.text("abc ", max_size=150), st.text("abcd ", max_size=200))


@given(st.lists(PAIRS, min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_many_alignments_are_the_single_ones(pairs):
    needles, texts = zip(*pairs)
    assert partial_alignments(needles, texts) == [partial_alignment(a, b) for a, b in pairs]


def test_alignment_of_long_needles():
    import random

    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "größe", "the", "of"]) for _ in range(n))
    texts = [prose(300) for _ in range(8)]
    needles = [t[40 : 40 + n] for t, n in zip(texts, (64, 65, 128, 129, 300, 511, 512, 700))]
    needles = [n[:20] + "~" + n[21:] for n in needles]
    assert partial_alignments(needles, texts) == [partial_alignment(a, b) for a, b in zip(needles, texts)]


def test_alignment_edges():
    assert partial_alignment("abc", "abc") == (100.0, 0, 3)
    assert partial_alignment("long needle here", "needle") == (100.0, 0, 6)
    assert partial_alignment("x", "").score == 0
    assert partial_alignment("xyz", "abc").score == 0
    assert unfolded("Ma\u00df f\u00fcr", 5) == 4 and unfolded("abc", 9) == 3


@pytest.mark.parametrize("raw, want", [("```json\n{}\n```", "{}"), ("```\n{}```", "{}"), ('Sure: {"a": 1}', '{"a": 1}'), ("  []\n", "[]"), ("no braces", "no braces"), ("```JSON\n{}```", "{}")])
def test_clean_json(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(clean_json_text(F.col("t"))).first()[0] == want


def test_decode():
    assert decode('{"a":1} x')["error"]
    assert decode("{}") == {"error": None, "kind": "list", "items": []}
    assert decode("[]")["kind"] == "top:list" and decode("null")["kind"] == "top:NoneType"
    assert decode('{"findings": "x"}')["kind"] == "str"
    items = decode('{"findings": [1, {"label_code": null, "snippet": true, "confidence": " HIGH ", "reasoning": 1.50}, {"x": NaN, "x": "\u00e9"}]}')["items"]
    assert items[0] == {"pos": 0, "kind": "int"}
    assert [items[1][k] for k in ("label_code", "snippet", "confidence", "reasoning")] == ["None", "True", "high", "1.5"]
    assert items[2]["raw"] == '{"x": "\u00e9"}' and items[2]["label_code"] == ""
    assert decode('{"findings": [{"snippet": "\\ud800"}]}')["items"][0]["snippet"] == "?"


def test_pages():
    assert assemble(["A b", "", "C"]) == {"full_cf": "a b  c", "full_display": "A b  C", "page_offsets": [0, 4, 5]}


def test_functions_in_sql(spark):
    from quotarium.functions.sql import register

    register(spark)
    r = spark.sql("""select quote_fold('Stra\\u00dfe  X') as f, quote_normal(null) as n, quote_align('abd', 'xxabcxx') as a, decode_answer('{"findings": []}').kind as k""").first()
    assert (r["f"], r["n"], r["k"]) == ("strasse x", "", "list") and round(r["a"]["score"], 2) == 66.67
