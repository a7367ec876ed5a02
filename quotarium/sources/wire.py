"""Result records in a landing folder, as JSON lines of either wire shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.operators.responses import WIRE


def read_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """custom_id, result, category, response_ord of landing/category=.../*.jsonl. Blank lines are skipped; a line that isn't JSON becomes a failed record, not a failed run."""
    reader = (spark.readStream if stream else spark.read).option("wholetext", "false")
    lines = reader.schema("value string, category string").text(path) if stream else reader.text(path)
    if "category" not in lines.columns:
        lines = lines.withColumn("category", F.lit(""))
    rows = lines.filter(F.trim("value") != "").select(F.col("category").cast("string").alias("category"), F.col("value"), F.from_json("value", WIRE + ", _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = F.col("r._corrupt_record").isNotNull() | F.col("r.result").isNull()
    failed = F.from_json(F.lit('{"type": "errored", "error_message": "result line is not a valid record"}'), WIRE.split("result ", 1)[1])
    out = rows.select("category", F.coalesce("r.custom_id", F.lit("")).alias("custom_id"), F.when(bad, failed).otherwise(F.col("r.result")).alias("result"))
    return out if stream else out.withColumn("response_ord", F.monotonically_increasing_id())  # streams get theirs batch by batch
