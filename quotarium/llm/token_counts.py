"""Token counts through a digest cache (operator 8).

The cache is a Parquet table (digest of the normalised content, number of tokens) with a folder for each digest of a tokenizer's version. Contents are joined to it;
what it lacks is encoded once for each distinct content and appended. Normalisation here only turns null into empty, since anything
else could change a count.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.llm.bpe import encoder
from quotarium.llm.common import bounded, hot_keys, scratch, small_batches, spread, written
from quotarium.storage import filesystem

CACHE = "digest binary, n_tokens long"


def version(tokenizer: str) -> str:
    """Digest of the tokenizer's file and of its library's version."""
    import sentencepiece
    import tokenizers

    with open(tokenizer, "rb") as f:
        return hashlib.sha256(f.read() + (sentencepiece.__version__ if tokenizer.endswith(".model") else tokenizers.__version__).encode()).hexdigest()


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; contents that the cache at the given path lacks are encoded, once each, and appended to it.

    Null text counts as empty (0 tokens). Repeated rows each get their count; a null doc_id is kept. Texts of any length are encoded whole. An empty table leaves the cache as it is. Only
    doc_id and text are read, so other columns can't clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cache, own = cache or scratch(spark, "token-cache"), version(tokenizer)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    keys = written(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-keys")
    # of contents that occur more than once, the row with the smallest doc_id is encoded; where that one repeats too, one of its rows
    per = keys.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    again = per.groupBy("digest").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("rows")).filter("rows > 1")
    again = written(again.select("digest", F.col("first.doc_id").alias("first_id"), F.col("first.n").alias("first_rows"), "rows"), "token-copies")
    hot = functools.cache(lambda: hot_keys(again, ["digest"], F.col("rows")))
    todo = spread(rows, again.select("digest", "first_id", "first_rows"), ["digest"], ["doc_id"], hot, "left", 120)
    todo = todo.filter(F.col("first_rows").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id")))
    stored = f"{cache}/tokenizer={own}"
    fs, at = filesystem(spark, stored)
    known = None
    if fs.exists(at):
        # few contents are sent to the cache; many meet it in a join on the digest
        mine = bounded(keys.select("digest").distinct(), 48)
        known = written(_read(spark, stored).join(mine, "digest", "left_semi").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "token-known")
        todo = todo.join(bounded(known.select("digest"), 96), "digest", "left_anti")
    once = todo.filter("first_rows > 1").select("digest", "text").dropDuplicates(["digest"])
    todo = todo.filter("first_rows is null or first_rows = 1").select("digest", "text").unionByName(once)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["digest"], pa.array([len(x) for x in enc.encode(b["text"])], pa.int64())], names=["digest", "n_tokens"])

    added = f"{stored}/{uuid.uuid4().hex}"
    todo.mapInArrow(encode, CACHE).write.option("compression", "zstd").parquet(added)
    counts = _read(spark, added)
    counts = counts if known is None else counts.unionByName(known)
    return spread(keys, counts, ["digest"], ["doc_id"], hot, "left", 96).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(path)
