"""Quality rules with adaptive thresholds (operator 2), in DataFrame functions only.

Measures of each text are summed up, for each language and source, in quantile sketches: counts of logarithmic buckets (7 leading bits, so values
are off by less than 1 %). Sketches merge by adding counts, so each task sums up its own rows before the shuffle, and the sketches of a language and of the
whole corpus are sums of the sources' sketches. A measure is out of range if it lies beyond the quartiles by more than `spread` times their distance and a
fixed slack. Small groups use their language's sketch, small languages the corpus'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotarium.llm.common import HOT_KEYS, HOT_ROWS, SHARES, bounded, spread, steps, written

WORD = r"[^\x20\x09-\x0D]+"
#: measure: slack in thousandths, and whether a low value counts too
MEASURES = {"word_length": (1500, True), "symbols": (300, False), "dup_lines": (400, False), "repeats": (350, False), "capitals": (700, False)}
SPREAD, LEAST_GROUP = 3, 100


def let(value: Column, body) -> Column:
    """Evaluates a column once and hands it to an expression that uses it often."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more; windows are sorted, never compared pairwise."""
    one = F.lit(1)

    def covered(at: Column) -> Column:
        # the union of [i, i + 3) over sorted starts
        return F.when(F.size(at) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(F.sequence(one, F.size(at)), F.lit(0).cast("long"), lambda a, k: a + F.when(k == F.size(at), F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), F.get(at, k) - F.get(at, k - 1)))))

    def starts(h: Column) -> Column:
        def flagged(p: Column) -> Column:
            alike = lambda j, k: F.coalesce(F.get(p, j)["h"] == F.get(p, k)["h"], F.lit(False))
            at = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda j: alike(j, j - 1) | alike(j, j + 1))
            return F.sort_array(F.transform(at, lambda j: F.get(p, j)["i"].cast("long")))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), flagged)

    def of(w: Column) -> Column:
        h = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(h, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(starts(h), covered)))

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(words, of))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base measures of every row; null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    return rows.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"), count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _repeated(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), count("[A-Z][A-Z]").alias("n_capitals"),
    )


def _bucket(v: Column) -> Column:
    """The value with its 7 leading bits kept: the lower end of its bucket."""
    shift = F.greatest(F.length(F.bin(v)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """Mergeable sketches: level (2 source, 1 language, 0 all), lang_key, source_key, measure, bucket, n."""
    one = rows.select("lang_key", "source_key", F.explode(F.create_map(*[x for m in MEASURES for x in (F.lit(m), F.col(m))])).alias("measure", "value"))
    own = one.withColumn("bucket", _bucket(F.col("value"))).groupBy("lang_key", "source_key", "measure", "bucket").agg(F.count("*").alias("n")).withColumn("level", F.lit(2))
    own = written(own, "sketches")
    by_lang = own.groupBy("lang_key", "measure", "bucket").agg(F.sum("n").alias("n")).select("lang_key", F.lit("").alias("source_key"), "measure", "bucket", "n", F.lit(1).alias("level"))
    of_all = own.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang_key"), F.lit("").alias("source_key"), "measure", "bucket", "n", F.lit(0).alias("level"))
    return own.unionByName(by_lang).unionByName(of_all)


def fences(sketch: DataFrame) -> DataFrame:
    """level, lang_key, source_key, rows and the lowest and highest value allowed of each measure."""
    by = ["level", "lang_key", "source_key", "measure"]
    up = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    q = sketch.withColumns({"cum": F.sum("n").over(up), "rows": F.sum("n").over(Window.partitionBy(*by))})
    q = q.groupBy(*by).agg(F.max("rows").alias("rows"), F.min(F.when(4 * F.col("cum") >= F.col("rows"), F.col("bucket"))).alias("q1"), F.min(F.when(4 * F.col("cum") >= 3 * F.col("rows"), F.col("bucket"))).alias("q3"))
    far = SPREAD * (F.col("q3") - F.col("q1"))
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, c))
    return q.groupBy("level", "lang_key", "source_key").agg(F.max("rows").alias("rows"), *[pick(m, F.col("q3") + far + s).alias(f"hi_{m}") for m, (s, _) in MEASURES.items()], *[pick(m, F.col("q1") - far - s).alias(f"lo_{m}") for m, (s, low) in MEASURES.items() if low])


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row.

    base_failed: fewer than 50 words, or more than half of them repeated. kept: base not failed and every measure within its group's fences. A null language or source
    is a group of its own; groups of fewer than LEAST_GROUP rows are judged by their language's sketch, and such languages by that of all rows. Null and empty texts fail the base. Repeated
    rows count each, texts of any length whole; an empty table gives no rows. Only doc_id, text, lang and source are read, so other columns can't clash.
    """
    base = written(measured(docs), "measured")
    base = base.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    key = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n"))
    base = base.withColumns({"lang_key": key("lang"), "source_key": key("source")})
    per = lambda c, d: F.expr(f"{c} * 1000 div {d}")
    rows = base.withColumns({"word_length": per("word_chars", "nullif(n_words, 0)"), "symbols": per("n_symbols", "nullif(n_words, 0)"), "dup_lines": per("n_dup_lines", "nullif(n_lines, 0)"), "repeats": per("n_repeat_words", "nullif(n_words, 0)"), "capitals": per("n_capitals", "nullif(n_words, 0)")})
    with steps(docs.sparkSession) as keep:
        limits = written(fences(sketches(rows.filter(~F.col("base_failed")))), "fences")
        names = [c for c in limits.columns if c[:3] in ("hi_", "lo_")]
        level = lambda k: limits.filter(F.col("level") == k).select("lang_key", "source_key", "rows", F.struct(*names).alias(f"at{k}")).withColumnRenamed("rows", f"rows{k}")
        one = level(2).join(bounded(level(1).drop("source_key"), 300), "lang_key", "left").join(F.broadcast(level(0).drop("lang_key", "source_key")), F.lit(True), "left")
        one = one.select("lang_key", "source_key", "rows2", F.when(F.col("rows2") >= LEAST_GROUP, F.col("at2")).when(F.col("rows1") >= LEAST_GROUP, F.col("at1")).otherwise(F.col("at0")).alias("at"))
        one = keep(written(one, "limits"))
    keys = ["lang_key", "source_key"]

    def hot() -> DataFrame:
        large = one.filter(F.col("rows2") > HOT_ROWS).orderBy(F.col("rows2").desc()).limit(HOT_KEYS)
        return F.broadcast(large.select(*keys, F.least(F.ceil(F.col("rows2") / HOT_ROWS), F.lit(SHARES)).cast("int").alias("shares")))

    out = spread(rows, one.drop("rows2"), keys, ["doc_id"], hot, "left", 300)
    within = F.lit(True)
    for m, (_, low) in MEASURES.items():
        within = within & (F.col(m) <= F.col(f"at.hi_{m}"))
        if low:
            within = within & (F.col(m) >= F.col(f"at.lo_{m}"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"))
