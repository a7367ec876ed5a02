"""An extension: answers verified as they land. The same operators run on each micro-batch; the stream's checkpoint takes the place of the run state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotarium.operators import audit, ladder, responses
from quotarium.settings import Settings
from quotarium.sources.wire import read_records


def verify_landing(spark: SparkSession, landing: str, files: DataFrame, labels: DataFrame, doc_texts: DataFrame, out: str, checkpoint: str, settings: Settings = Settings(), run_ts: str | None = None) -> StreamingQuery:
    """Reads landing/category=.../ as files come and writes audit and error rows under `out`, a folder for each micro-batch, so a batch that runs again replaces itself."""
    records = read_records(spark, landing, stream=True)

    def handle(batch: DataFrame, n: int) -> None:
        batch = batch.withColumn("response_ord", F.monotonically_increasing_id()).persist()
        try:
            answers = responses.decoded(responses.with_filenames(responses.results(batch), files), labels)
            found, bad = responses.findings(answers, run_ts), responses.errors(answers, run_ts)
            audit.audit(ladder.verify(found, doc_texts, settings)).write.mode("overwrite").parquet(f"{out}/verified/batch={n}")
            bad.write.mode("overwrite").parquet(f"{out}/errors/batch={n}")
        finally:
            batch.unpersist()

    return records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def paced_usage(spark: SparkSession, events: DataFrame, checkpoint: str, out: str, window: str = "60 seconds", late: str = "10 minutes") -> StreamingQuery:
    """Tokens used in each tumbling window of a usage stream (ts, tokens), with a watermark for late rows."""
    used = events.withWatermark("ts", late).groupBy(F.window("ts", window)).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("requests"))
    flat = used.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "tokens", "requests")
    return flat.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
