"""The match ladder: is a quote in its document, how surely, and on which page.

Findings meet their document once. The exact and the fragmented rung are built-in expressions on the joined row; only rows that both
leave open hand their text to Python for the fuzzy rung. No row meets a document other than its own.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quotarium import settings as S
from quotarium.functions.alignment import Aligned, partial_alignments, unfolded
from quotarium.functions.text import fragments, normalize
from quotarium.operators.assembly import page_at
from quotarium.settings import Settings
from quotarium.storage import small_batches, written

LEAST_FRAGMENT = 3
VERDICT = ("verification_status", "match_score", "match_method", "page_number", "matched_text")


def exact_place(text: Column, needle: Column) -> Column:
    """0-based place of the first occurrence, or null."""
    return F.nullif(F.instr(text, needle), F.lit(0)) - 1


def fragments_place(text: Column, pieces: Column) -> Column:
    """Least 0-based place of the pieces, or null unless each is in the text. A piece is sought behind the one before, then anywhere; pieces of under three characters don't count."""
    start = F.struct(F.lit(True).alias("ok"), F.lit(1).alias("cursor"), F.lit(None).cast("int").alias("least"))

    def step(a: Column, piece: Column) -> Column:
        behind = F.call_function("locate", piece, text, a["cursor"])
        at = F.when(behind > 0, behind).otherwise(F.instr(text, piece))
        found = F.struct((a["ok"] & (at > 0)).alias("ok"), (at + F.length(piece)).alias("cursor"), F.least(a["least"], at).alias("least"))
        return F.when(a["ok"], found).otherwise(a)

    counted = F.filter(pieces, lambda p: F.length(p) >= LEAST_FRAGMENT)
    return F.aggregate(counted, start, step, lambda a: F.when(a["ok"], a["least"] - 1))


def prepared(findings: DataFrame) -> DataFrame:
    """Adds the case-folded snippet and its pieces: done on short texts, before they meet their document."""
    return findings.withColumns({"snippet_cf": normalize(F.col("snippet"), fold=True), "pieces": fragments(F.col("snippet"))})


def joined(findings: DataFrame, docs: DataFrame) -> DataFrame:
    own = docs.select("filename", F.lit(True).alias("in_corpus"), "has_text_layer", "full_cf", "full_display", "page_offsets")
    return prepared(findings).join(own, "filename", "left")


#: Pairs and characters that are aligned at once.
PAIRS, LETTERS = 256, 1 << 21
_FUZZY = T.StructType().add("score", T.DoubleType()).add("start", T.IntegerType()).add("end", T.IntegerType())


def _aligned(needles: list[str | None], texts: list[str | None]) -> list[Aligned | None]:
    """Alignments of the pairs that have a text, block by block."""
    out: list[Aligned | None] = [None] * len(texts)
    block, size = [], 0
    for i, text in enumerate(texts):
        if text is not None:
            block.append(i)
            size += len(text)
        if block and (len(block) == PAIRS or size >= LETTERS or i == len(texts) - 1):
            for k, a in zip(block, partial_alignments([needles[k] for k in block], [texts[k] for k in block])):
                out[k] = a
            block, size = [], 0
    return out


@F.arrow_udf(_FUZZY)
def _fuzzy(needle: pa.Array, text: pa.Array) -> pa.Array:
    return pa.array([None if a is None else a._asdict() for a in _aligned(needle.to_pylist(), text.to_pylist())], to_arrow_type(_FUZZY))


@F.arrow_udf(T.StringType())
def _shown(display: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    """Slices of texts at places of their case-folded forms."""
    rows = zip(display.to_pylist(), start.to_pylist(), end.to_pylist())
    return pa.array([None if t is None else t[unfolded(t, a) : unfolded(t, z)] for t, a, z in rows], pa.string())


def verify(findings: DataFrame, docs: DataFrame, settings: Settings = Settings(), fuzzy: bool = True) -> DataFrame:
    """The findings with a verdict each: status, score, method, page_number and matched_text.

    findings: at least filename and snippet; docs: as assembly gives them, one row a filename. Without fuzzy the third rung is left
    out, and what the first two don't find is not_found with score 0. A finding of a file that the corpus lacks is pdf_missing; blank snippets are not_found.
    """
    small_batches(docs.sparkSession)
    names = [c for c in findings.columns if c not in VERDICT]
    rows = joined(findings.select(*names), docs)
    layer = F.coalesce(F.col("has_text_layer"), F.lit(False))
    exact = F.when(layer & (F.col("snippet_cf") != ""), exact_place(F.col("full_cf"), F.col("snippet_cf")))
    rows = rows.withColumn("exact", exact)
    # pieces are null for nearly all rows; the fold then costs nothing
    rows = rows.withColumn("parts", F.when(layer & F.col("exact").isNull() & (F.col("snippet_cf") != "") & F.col("pieces").isNotNull(), fragments_place(F.col("full_cf"), F.col("pieces"))))
    found = F.coalesce("exact", "parts")
    still = layer & found.isNull() & (F.col("snippet_cf") != "")
    status = F.when(F.col("in_corpus").isNull(), S.MISSING).when(~layer, S.NO_TEXT_LAYER).when(F.col("exact").isNotNull(), S.VERIFIED).when(F.col("parts").isNotNull(), S.FRAGMENTED)
    if not fuzzy:
        score = F.when(found.isNotNull(), F.lit(100.0)).otherwise(F.lit(0.0))
        method = F.when(F.col("exact").isNotNull(), "exact").when(F.col("parts").isNotNull(), "fragmented").otherwise("none")
        return rows.select(*names, F.coalesce(status, F.lit(S.NOT_FOUND)).alias("verification_status"), score.alias("match_score"), method.alias("match_method"), page_at(F.col("page_offsets"), found).alias("page_number"), F.lit("").alias("matched_text"))
    # only texts of rows that are still open go to Python; the others' arguments are null
    first = rows.select(*names, "page_offsets", "full_display", status.alias("first_status"), found.alias("found"), F.length("snippet_cf").alias("snippet_length"), _fuzzy(F.when(still, F.col("snippet_cf")), F.when(still, F.col("full_cf"))).alias("fuzzy"))
    score, start, end = (F.col(f"fuzzy.{c}") for c in ("score", "start", "end"))
    near = F.coalesce(score >= settings.near_threshold, F.lit(False))
    sure = (score >= settings.fuzzy_threshold) & (F.col("snippet_length") >= settings.min_fuzzy_length)
    final = F.coalesce("first_status", F.when(near & sure, S.FUZZY).when(near, S.NEAR).otherwise(S.NOT_FOUND))
    method = F.when(F.col("first_status") == S.VERIFIED, "exact").when(F.col("first_status") == S.FRAGMENTED, "fragmented").when(near, "fuzzy").otherwise("none")
    place = F.coalesce("found", F.when(near, start))
    total = F.when(F.col("found").isNotNull(), F.lit(100.0)).otherwise(F.coalesce(score, F.lit(0.0)))
    if settings.compat_matched_text:
        shown = F.when(near, F.substr("full_display", start + 1, end - start))
    else:
        shown = _shown(F.when(near, F.col("full_display")), start, end)
    return first.select(*names, final.alias("verification_status"), total.alias("match_score"), method.alias("match_method"), page_at(F.col("page_offsets"), place).alias("page_number"), F.coalesce(shown, F.lit("")).alias("matched_text"))


#: Letters by which passages of one or two words are sought.
GRAM = 4
#: Bytes of sought hashes that may be sent to every task.
SOUGHT_BYTES = 64 << 20


def _runs(items: Column, n: int, of) -> Column:
    """Hashes of all runs of n items; none where there are fewer."""
    return F.when(F.size(items) >= n, F.transform(F.sequence(F.lit(0), F.size(items) - n), lambda i: of(items, i, n))).otherwise(F.array().cast("array<long>"))


def located(passages: DataFrame, docs: DataFrame, words: int = 5) -> DataFrame:
    """key, filename, place of each passage (key, text) in each document that holds it, wherever words are cut: containment as an equi join.

    A document that holds a passage holds its inner words one after another, so documents' runs of words meet the passages' first inner run by
    hash, and only such pairs are compared. Passages of two words or less have no inner words; the letters they begin with are sought among the documents' runs of letters.
    Texts are put together and written once, and taken apart once for all lengths of runs that occur.
    """
    small_batches(passages.sparkSession)
    own = passages.select("key", normalize(F.col("text"), fold=True).alias("needle")).filter("needle <> ''")
    own = own.withColumn("inner", F.expr("slice(split(needle, ' '), 2, greatest(size(split(needle, ' ')) - 2, 0))")).withColumn("k", F.least(F.size("inner"), F.lit(words)))
    hashed = lambda kind, k, parts: F.xxhash64(F.lit(kind), F.lit(k), *parts)
    by_words = lambda w, i, k: hashed("words", k, [F.get(w, i + j) for j in range(k)])
    by_letters = lambda c, i, k: hashed("letters", k, [F.get(c, i + j) for j in range(k)])
    letters = F.least(F.length("needle"), F.lit(GRAM))
    run = F.when(F.col("k") > 0, F.col("k")).otherwise(-letters)
    own = written(own.withColumn("kind", run), "passages")
    kinds = sorted(r["kind"] for r in own.select("kind").distinct().collect())  # `words` + GRAM values at most
    if not kinds:
        return own.select("key", F.lit("").alias("filename"), F.lit(0).cast("long").alias("place"))
    texts = written(docs.select("filename", "full_cf"), "texts")
    split = texts.withColumn("w", F.filter(F.split("full_cf", " "), lambda x: x != ""))
    if kinds[0] < 0:
        split = split.withColumn("c", F.split("full_cf", ""))
    every, sought = [], None
    for k in kinds:
        n, items, of = (-k, "c", by_letters) if k < 0 else (k, "w", by_words)
        every.append(_runs(F.col(items), n, of))
        mine = own.filter(F.col("kind") == k).select("key", "needle", of(F.split("needle", "") if k < 0 else F.col("inner"), F.lit(0), n).alias("run"))
        sought = mine if sought is None else sought.unionByName(mine)
    sought = written(sought, "sought")
    few = sought.count() * 64 + (sought.agg(F.sum(F.octet_length("needle"))).first()[0] or 0) <= SOUGHT_BYTES
    runs = split.select("filename", F.explode(F.array_distinct(F.flatten(F.array(*every)))).alias("run"))
    pairs = runs.join(F.broadcast(sought.select("run", "key")) if few else sought.select("run", "key"), "run").select("filename", "key").distinct()
    met = pairs.join(F.broadcast(sought.select("key", "needle")) if few else sought.select("key", "needle"), "key").join(texts, "filename")
    return met.select("key", "filename", F.instr("full_cf", F.col("needle")).alias("at")).filter("at > 0").select("key", "filename", (F.col("at") - 1).cast("long").alias("place"))
