"""The training-data pipeline: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.llm import exact_dedup, language_id, minhash, packing, quality_crf
from quotarium.llm.common import bounded, discard, scratch, steps, table, written

#: A language is believed from this score on.
LEAST_LANGUAGE = 0.4


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts of no language that the model knows well enough.

    So null and empty texts go, and so do all if no row has a language to learn from. Each row is judged by its own whole text, whatever its doc_id; all columns stay as they are.
    """
    return language_id.recognised(docs, language_id.train(docs), LEAST_LANGUAGE)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line model holds for bad.

    Null and empty texts score 0.5 and go. Each row is judged by its own whole text, whatever its doc_id; all columns stay as they are. Without labels all rows score 0.5 and go.
    """
    return quality_crf.good(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null counts as empty. A null doc_id is the smallest; rows that share the largest doc_id and the text all stay, since nothing tells them apart. All columns stay as they are.
    """
    found = exact_dedup.exact_dedup(docs)
    gone = bounded(written(found.filter("not kept").select(F.col("doc_id").alias("gone_id"), "text_sha256").distinct(), "copies"), 128)
    mark = exact_dedup.sha(exact_dedup.normalised(docs["text"]))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (mark == gone["text_sha256"]), "left_anti")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays: the one with the smallest doc_id.

    If a doc_id is null or repeats, rows are numbered in the order of doc_id (null last) and text, and judged each by its own text under that number. Texts without words have no
    near copies and stay. All columns stay as they are.
    """
    doc_id = docs["doc_id"].cast("long")
    rows, ids = docs.agg(F.count("*"), F.count_distinct(doc_id)).first()
    key = "doc_id"
    if ids < rows:
        key = "near_copy_row"
        docs = written(docs.orderBy(doc_id.asc_nulls_last(), F.xxhash64("text"), "text").withColumn(key, F.monotonically_increasing_id()), "numbered")
    judged = minhash.near_duplicates(docs.select(docs[key].alias("doc_id"), "text"))
    gone = bounded(written(judged.filter("not kept").select(F.col("doc_id").alias("gone_id")).distinct(), "near-copies"), 24)
    left = docs.join(gone, docs[key] == gone["gone_id"], "left_anti")
    return left if key == "doc_id" else left.drop(key)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece, with the columns of packing.pack alone. Null texts are packed as empty ones, repeated rows each, long texts in pieces."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", by_language), ("quality", by_quality), ("exact_dedup", without_copies), ("near_dedup", without_near_copies), ("packing", packed)]
#: The classifiers' stages can't be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents. Once a stage's rows are written, what it and the stage before it left on the shared storage is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        with steps(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
