"""The corpus' files and the matrix of documents and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotarium.functions import ids
from quotarium.settings import NATIVE_SUFFIXES, OFFICE_SUFFIXES
from quotarium.storage import written

# US dollars for a request, by provider and by what the model's name contains.
RATES = {("batch", "opus"): 0.06, ("batch", "sonnet"): 0.01, ("batch", ""): 0.005, ("synchronous", ""): 0.02}
OTHER_RATE = 0.005


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def documents(paths: DataFrame, limit: int | None = None) -> DataFrame:
    """path, filename, idx (from 1, by path) of the files that are documents, the first `limit` of them."""
    found = paths.filter(suffix(F.col("path")).isin(*NATIVE_SUFFIXES, *OFFICE_SUFFIXES)).select("path", ids.basename(F.col("path")).alias("filename"))
    if limit is not None and limit <= LEAST_DEALT:  # that many rows are one task's work
        return found.orderBy("path").limit(limit).withColumn("idx", F.row_number().over(Window.orderBy("path")).cast("long"))
    dealt = _dealt(found, "path", 64)
    return dealt if limit is None else dealt.filter(F.col("idx") <= limit)


#: Up to so many rows are numbered by one task.
LEAST_DEALT = 100_000


def _dealt(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """The rows with idx, their number from 1 by the key. Rows are dealt by ranges of keys and numbered inside them, so no task gets all."""
    dealt = written(rows.repartitionByRange(partitions, key).withColumn("part", F.spark_partition_id()), "numbered")
    before = dealt.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    own = F.row_number().over(Window.partitionBy("part").orderBy(key))
    return dealt.join(F.broadcast(before), "part").select(*rows.columns, (own + F.col("before")).cast("long").alias("idx"))  # a row for each of the partitions


def numbered(files: DataFrame, partitions: int = 64) -> DataFrame:
    """filename, file_id, idx: numbers from 1 by filename."""
    return _dealt(files.select("filename", "file_id"), "filename", partitions)


def request_matrix(files: DataFrame, prompts: DataFrame) -> DataFrame:
    """category, cat_ord, idx, custom_id, filename, file_id, prompt: each document with each category's prompt.

    Prompts are as many as a framework has categories, a hand-written sheet; they are what is broadcast.
    """
    return files.withColumn("custom_id", ids.custom_id(F.col("filename"), F.col("idx"))).crossJoin(F.broadcast(prompts)).select("category", "cat_ord", "idx", "custom_id", "filename", "file_id", "prompt")


def batch_bodies(requests: DataFrame, model: str, max_tokens: int) -> DataFrame:
    """category, custom_id and the JSON body of each request of a batch; fields that are null are left out."""
    part = lambda kind, file_id, text: F.struct(F.lit(kind).alias("type"), F.when(file_id.isNotNull(), F.struct(F.lit("file").alias("type"), file_id.alias("file_id"))).alias("source"), text.alias("text"))
    content = F.array(part("document", F.col("file_id"), F.lit(None).cast("string")), part("text", F.lit(None).cast("string"), F.col("prompt")))
    params = F.struct(F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("messages"))
    return requests.select("category", "custom_id", F.to_json(F.struct("custom_id", params.alias("params"))).alias("body"))


def data_uri(content: Column) -> Column:
    return F.concat(F.lit("data:application/pdf;base64,"), F.translate(F.base64(content), "\r\n", ""))  # Spark breaks lines


def rate(provider: str, model: str) -> float:
    provider, model = provider.strip().lower(), model.lower()
    return next((r for (p, m), r in RATES.items() if p == provider and m in model), OTHER_RATE)


def cost_estimate(files: DataFrame, framework: DataFrame, provider: str, model: str) -> DataFrame:
    """n_documents, n_categories, n_requests, cost_per_request, cost."""
    n = files.agg(F.count("*").alias("n_documents"))
    c = framework.agg(F.countDistinct("category").alias("n_categories"))
    per = rate(provider, model)
    out = n.crossJoin(c).withColumn("n_requests", F.col("n_documents") * F.col("n_categories"))
    return out.select("n_documents", "n_categories", "n_requests", F.lit(per).alias("cost_per_request"), (F.col("n_requests") * F.lit(per)).alias("cost"))
