"""Relations that the catalog's queries start from, derived from the given tables by rules that Spark and SQL spell alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.operators import assembly, framework, requests
from quotarium.storage import written

COLUMNS = ["Category", "Code", "Description", "Inclusion Criteria", "Exclusion Criteria"]
# A small framework, with categories out of order, one code in two of them, and labels without exclusions.
FRAMEWORK = [
    ("Outcomes", "OUT_GAIN", "A gain was measured", "A number or a comparison shows a gain", "Plans and hopes"),
    ("Methods", "MET_SURVEY", "A survey was held", "People were asked", ""),
    ("Outcomes", "OUT_LOSS", " A loss was measured ", "A number shows a loss", "Losses of others"),
    ("Barriers", "COST", "Costs stand in the way", "Money is named as a reason", "Prices alone"),
    ("Methods", "MET_TRIAL", "A trial was run", "Something was tried out", "Trials in court"),
    ("Outcomes", "COST", "What it cost", "A sum of money is given", ""),
    ("Barriers", "BAR_LAW", "Law stands in the way", "A rule is named as a reason", ""),
]
DEFECTS = [*FRAMEWORK, ("Methods", " MET_SURVEY", "again", "twice", ""), ("Barriers", "COST ", "again", "twice", None)]
FABRICATED = "The committee of nineteen lighthouses never agreed on the colour of the harbour bell."
CATEGORY = ["Outcomes", "Methods", "Barriers"]
GOOD_CODE = {"Outcomes": "OUT_GAIN", "Methods": "MET_TRIAL", "Barriers": "COST"}
RUN_TS = "2024-01-01T00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labels(spark: SparkSession, rows=FRAMEWORK) -> DataFrame:
    return framework.validated(framework.from_rows(spark, COLUMNS, [list(r) for r in rows]))


def filename():
    return F.format_string("doc_%06d.pdf", F.col("doc_id"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select(filename().alias("filename"), F.concat(F.lit("file_"), F.col("doc_id")).alias("file_id"))
    return requests.numbered(own, 16)


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.texts_as_documents(table(spark, sf_dir, "documents"), filename())


def cut():
    return F.expr("substr(text, cast(1 + (doc_id * 37) % greatest(length(text) - 120, 1) as int), 100)")


def findings(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A quote from every document; of seven, one names a file that isn't there and one is made up."""
    quote = {
        "exact": F.when(F.col("doc_id") % 2 == 0, F.upper("cut")).otherwise(F.regexp_replace("cut", " ", "\u00a0")),
        "fragmented": F.concat(F.substring("cut", 1, 30), F.lit(" ... "), F.substring("cut", 61, 30)),
        "fuzzy": F.regexp_replace("cut", "^(.{40}).(.{30}).", "$1~$2~"),
    }[kind]
    rows = table(spark, sf_dir, "documents").withColumn("cut", cut())
    name = F.when(F.col("doc_id") % 7 == 3, F.lit("elsewhere.pdf")).otherwise(filename())
    snippet = F.when(F.col("doc_id") % 7 == 5, F.lit(FABRICATED)).otherwise(quote)
    return rows.select(F.concat(F.lit(f"{kind}_"), F.floor(F.col("doc_id") / 2)).alias("snippet_id"), name.alias("filename"), snippet.alias("snippet"), F.col("doc_id").alias("finding_ord"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each line of a text a page with a running header, the line as its body, and its first letters as a footer."""
    lines = table(spark, sf_dir, "documents").select(filename().alias("filename"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"))
    part = lambda k, text, y0, y1: F.struct(F.lit(k).alias("block_no"), text.alias("text"), F.lit(y0).alias("y0"), F.lit(y1).alias("y1"))
    page = (F.col("at") + 1).cast("int")
    three = F.array(part(0, F.concat(F.lit("Journal Vol. 5 page "), page), 18.0, 32.0), part(1, F.col("line"), 300.0, 340.0), part(2, F.substring("line", 1, 6), 740.0, 752.0))
    return lines.select("filename", page.alias("page_no"), F.explode(three).alias("b")).select("filename", "page_no", "b.*", F.lit(792.0).alias("page_height"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer of one of fourteen kinds for every document: category, response_ord, custom_id, success, text, error_message."""
    docs = table(spark, sf_dir, "documents").withColumn("k", F.col("doc_id") % 14).withColumn("quote", F.expr("substr(text, cast(1 + (doc_id * 11) % greatest(length(text) - 70, 1) as int), 60)"))
    category = F.element_at(F.array(*map(F.lit, CATEGORY)), (F.col("doc_id") % 3 + 1).cast("int"))
    docs = docs.withColumn("category", category).withColumn("good", F.create_map(*[F.lit(x) for kv in GOOD_CODE.items() for x in kv])[F.col("category")])
    item = lambda code: F.to_json(F.struct(code.alias("label_code"), F.col("quote").alias("snippet"), F.lit(" it says so ").alias("reasoning"), F.lit("High").alias("confidence")), {"ignoreNullFields": "false"})
    of = lambda *items: F.concat(F.lit('{"findings": ['), F.concat_ws(", ", *items), F.lit("]}"))
    good = of(item(F.col("good")))
    one = item(F.col("good"))
    kinds = {
        0: good, 1: F.concat(F.lit("```json\n"), good, F.lit("\n```")), 2: F.concat(F.lit("Here it is: "), good), 3: F.concat(good, F.lit(" as you asked")),
        4: F.lit(""), 6: F.lit("{}"), 7: F.lit('{"findings": "x"}'), 8: F.lit("[]"), 9: of(F.lit("1"), one), 10: of(item(F.lit("  ")), one),
        11: of(item(F.lit(None).cast("string"))), 12: of(item(F.lit("OUT_NEW")), one), 13: of(one, F.lit('"no"'), one),
    }
    text = F.lit(None).cast("string")
    for k, t in kinds.items():
        text = F.when(F.col("k") == k, t).otherwise(text)
    ok = F.col("k") != 5
    custom = F.when(F.col("doc_id") % 10 == 9, F.lit("req-lost")).otherwise(F.concat(F.lit("req-"), F.format_string("%04d", F.col("doc_id") + 1), F.lit("-"), F.regexp_replace(filename(), "[^a-zA-Z0-9_-]", "_")))
    out = docs.select("category", F.col("doc_id").alias("response_ord"), custom.alias("custom_id"), ok.alias("success"), text.alias("text"), F.when(~ok, "overloaded").alias("error_message"))
    return written(out, "responses")  # as a provider's answers are: else each step would repeat the expressions


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("lane"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), F.round(F.col("value") * 100).cast("long").alias("tokens"))
