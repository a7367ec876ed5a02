"""From a provider's records to findings and typed errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotarium.functions import ids
from quotarium.functions.answers import clean_json_text, decode_answer
from quotarium.functions.text import strip
from quotarium.storage import small_batches

#: Both wire shapes at once: nested (message.content, error.message) and flat (text, error_message).
WIRE = "custom_id string, result struct<type: string, text: string, error_message: string, message: struct<content: array<struct<type: string, text: string>>>, error: struct<message: string>>"
# What the error rows say.
UNKNOWN_ERROR, NO_TEXT = "Unknown API error", "LLM returned no text content blocks."
NOT_LIST, NOT_OBJECT, NO_FIELDS = "'findings' field is not a list: ", "Finding #%d is not a dict: %s", "Finding #%d missing label_code or snippet."
BAD_CODE = "Finding #%d: label_code '%s' is not in category '%s'. Valid: "
RAW_LENGTH = 2000


def results(records: DataFrame) -> DataFrame:
    """Wire records as custom_id, success, text, error_message (and the columns besides). Text blocks are joined by newlines and stripped; a failed record has no text."""
    r = F.col("result")
    blocks = F.transform(F.filter(r["message"]["content"], lambda c: c["type"] == "text"), lambda c: F.coalesce(c["text"], F.lit("")))
    nested = F.nullif(strip(F.array_join(blocks, "\n")), F.lit(""))
    ok = F.coalesce(r["type"] == "succeeded", F.lit(False))
    why = F.coalesce(r["error"]["message"], r["error_message"], F.concat(F.lit("result type: "), F.coalesce(r["type"], F.lit("none"))))
    return records.select(*[c for c in records.columns if c != "result"], ok.alias("success"), F.when(ok, F.coalesce(nested, F.nullif(r["text"], F.lit("")))).alias("text"), F.when(~ok, why).alias("error_message"))


def counts(responses: DataFrame) -> DataFrame:
    """category, succeeded, errored."""
    return responses.groupBy("category").agg(F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("errored"))


def with_filenames(responses: DataFrame, files: DataFrame) -> DataFrame:
    """Adds filename by custom_id; unknown where no file has it."""
    own = files.select(ids.custom_id(F.col("filename"), F.col("idx")).alias("custom_id"), "filename")
    return responses.drop("filename").join(own, "custom_id", "left").withColumn("filename", F.coalesce("filename", F.lit("unknown")))


def decoded(responses: DataFrame, framework: DataFrame) -> DataFrame:
    """One row for each response: error_type and error_message of the whole answer if any, items otherwise. Needs category, response_ord, filename, success, text, error_message.

    The codes of a category come from a hand-written sheet and are broadcast with it.
    """
    small_batches(responses.sparkSession)
    codes = framework.groupBy("category").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    rows = responses.join(F.broadcast(codes), "category", "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    usable = F.col("success") & (F.coalesce("text", F.lit("")) != "")
    rows = rows.withColumn("answer", decode_answer(F.when(usable, clean_json_text(F.col("text")))))
    kind = F.col("answer.kind")
    which = F.when(~F.col("success"), "api_error").when(~usable, "no_text").when(F.col("answer.error").isNotNull(), "json_parse_failed").when(kind != "list", "invalid_structure")
    wrong = F.when(kind.startswith("top:"), F.concat(F.lit("answer is not an object: "), F.substring(kind, 5, 100))).otherwise(F.concat(F.lit(NOT_LIST), kind))
    said = F.when(~F.col("success"), F.coalesce(F.nullif("error_message", F.lit("")), F.lit(UNKNOWN_ERROR))).when(~usable, NO_TEXT).otherwise(F.coalesce("answer.error", wrong))
    raw = F.when(which.isin("json_parse_failed", "invalid_structure"), F.col("text")).otherwise("")
    return rows.select("category", "response_ord", "filename", "codes", which.alias("error_type"), F.when(which.isNotNull(), said).alias("error_message"), raw.alias("raw_text"), F.when(which.isNull(), F.col("answer.items")).alias("items"))


def _items(answers: DataFrame) -> DataFrame:
    one = answers.select("category", "response_ord", "filename", "codes", F.explode("items").alias("i"))
    kind, code = F.col("i.kind"), F.col("i.label_code")
    n = F.col("i.pos")
    known = F.array_contains("codes", code)
    which = F.when(kind != "dict", "invalid_finding_item").when((code == "") | (F.col("i.snippet") == ""), "missing_fields").when(~known, "hallucinated_code")
    listed = F.concat(F.lit("["), F.array_join(F.transform("codes", lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))
    said = F.when(which == "invalid_finding_item", F.format_string(NOT_OBJECT, n, kind)).when(which == "missing_fields", F.format_string(NO_FIELDS, n)).when(which.isNotNull(), F.concat(F.format_string(BAD_CODE, n, code, F.col("category")), listed))
    raw = F.when(which.isin("missing_fields", "hallucinated_code"), F.col("i.raw")).otherwise("")
    return one.select("category", "response_ord", "filename", "i.*", which.alias("error_type"), said.alias("error_message"), raw.alias("raw_text"))


def findings(answers: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The valid elements: the ten finding columns (page_number still null) and finding_ord, which orders and identifies them."""
    kept = _items(answers).filter("error_type is null")
    seq = F.row_number().over(Window.partitionBy("category", "response_ord").orderBy("pos"))
    own = kept.withColumn("seq", seq)
    return own.select(
        ids.snippet_id(F.col("filename"), F.col("category"), F.col("seq")).alias("snippet_id"), "filename", F.col("category").alias("label_category"), "label_code", "snippet",
        F.lit(None).cast("long").alias("page_number"), "reasoning", "confidence", ids.iso_seconds(run_ts).alias("timestamp"),
        ids.finding_hash(F.col("filename"), F.col("category"), F.col("label_code"), F.col("snippet")).alias("finding_hash"),
        F.struct("category", "response_ord", "pos").alias("finding_ord"),
    )


def errors(answers: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The six error columns and finding_ord."""
    whole = answers.filter("error_type is not null").select("category", "response_ord", F.lit(-1).alias("pos"), "filename", "error_type", "error_message", "raw_text")
    rows = whole.unionByName(_items(answers).filter("error_type is not null").select("category", "response_ord", "pos", "filename", "error_type", "error_message", "raw_text"))
    cut = lambda c: F.substring(c, 1, RAW_LENGTH)
    return rows.select("filename", F.col("category").alias("label_category"), "error_type", "error_message", cut(F.col("raw_text")).alias("raw_text"), ids.iso_seconds(run_ts).alias("timestamp"), F.struct("category", "response_ord", "pos").alias("finding_ord"))


def hallucinated(found: DataFrame, framework: DataFrame) -> DataFrame:
    """Findings whose code isn't in their category: an anti join."""
    codes = framework.select(F.col("category").alias("label_category"), F.col("code").alias("label_code")).distinct()
    return found.join(F.broadcast(codes), ["label_category", "label_code"], "left_anti")


def merge_runs(*runs: DataFrame) -> DataFrame:
    """Findings of several runs, one for each finding_hash: that of the earliest run."""
    rows = None
    for i, r in enumerate(runs):
        own = r.withColumn("run", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    cols = [c for c in runs[0].columns if c != "finding_hash"]
    first = rows.groupBy("finding_hash").agg(F.min_by(F.struct(*cols), F.struct("run", "snippet_id")).alias("f"))
    return first.select("finding_hash", "f.*").select(*runs[0].columns)
