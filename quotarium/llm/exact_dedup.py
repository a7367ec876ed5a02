"""Exact deduplication as a stateful stream (operator 3).

State is keyed by a digest of the normalised text and kept on disk (RocksDB), with no expiry: a
copy that comes years later still meets its first text. For a digest the state holds the largest
stable identifier seen, the locator of that row's content (file and row number in it) and the number of rows. Every task sums up
a digest's rows before the shuffle, so a text with a third of all rows costs one row a task.

A hit is not believed: the content at each locator is fetched, the full bytes of every row whose digest occurs twice or more are compared with
it, and rows that differ (a collision) are grouped again by their bytes. Rows of a frequent digest are dealt over many tasks for that.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.llm.common import ascii_lower, bounded, hot_keys, scratch, spread, written

#: State on disk. A changelog is written for each batch instead of a whole snapshot, and files take the space they need: there is a database for each
#: shuffle partition, and by default each reserves several MB beforehand.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _pattern(path: str) -> str:
    """The streaming source reads folders or patterns; as a pattern that matches itself alone, a path may also be one file."""
    own = path.rstrip("/")
    return own if any(c in "{}[]*?\\" for c in own) or not own[-1].isalnum() else f"{own[:-1]}[{own[-1]}]"


UPDATES = "digest string, keep_id long, locator string, locator_row long, group_size long, batch long"


def known(spark: SparkSession, state: str) -> DataFrame:
    """All updates of a state, of any call: a digest's row with the largest group_size is its state."""
    return spark.read.schema(UPDATES).option("recursiveFileLookup", "true").parquet(f"{state}/updates")


def stream_keys(spark: SparkSession, path: str, schema, digest, state: str | None = None) -> tuple[DataFrame, str]:
    """Streams what is new under a path into the keyed state; returns all updates of this call and the state's folder.

    Call it again with the same state folder and only files not seen yet are read; their updates carry what the state knows of earlier rows.
    """
    last = -1
    if state:
        last = known(spark, state).agg(F.max("batch")).first()[0]
        last = -1 if last is None else last
    state = state or scratch(spark, "dedup-state")
    rows = spark.readStream.schema(schema).parquet(_pattern(path))
    at = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    keyed = rows.select(digest(normalised(F.col("text"))).alias("digest"), at.alias("at"))
    states = keyed.groupBy("digest").agg(F.max("at").alias("at"), F.count("*").alias("group_size"))
    states = states.select("digest", F.col("at.doc_id").alias("keep_id"), F.col("at.file").alias("locator"), F.col("at.row").alias("locator_row"), "group_size")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        run = (
            states.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{state}/checkpoint")
            .foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{state}/updates/step={n}"))
            .start()
        )
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    spark.createDataFrame([], UPDATES).write.mode("append").parquet(f"{state}/updates/none")  # so that there is a table even without a row
    return known(spark, state).filter(F.col("batch") > last), state


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup_files(spark: SparkSession, path: str, schema, digest=sha, state: str | None = None) -> DataFrame:
    """Classes of equal texts among the Parquet rows at a path.

    Returns for every row: doc_id, keep_id (largest doc_id of the class), group_size, kept, text_sha256 (of the normalised text).
    Null texts count as empty; empty texts are one class; a text of any length is compared whole. A null doc_id is smaller than any other; rows of one doc_id and text are all kept
    if theirs is the largest (they can't be told apart). An empty table gives an empty result; other columns are ignored, whatever their names.

    With the folder of an earlier call's state only files that it hasn't seen are streamed; keep_id and group_size then count all rows ever seen, and
    the rows returned are those at the path now. What a state locates must still be there.
    """
    _, state = stream_keys(spark, path, schema, digest, state)
    # the largest row count is the last update of a key
    found = known(spark, state).groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max_by(F.struct("keep_id", "locator", "locator_row"), "group_size").alias("at"))
    found = written(found.filter("group_size > 1").select("digest", "group_size", "at.*"), "dedup-hits")
    files = spark.read.schema(schema).parquet(path)
    text = normalised(F.col("text"))
    docs = files.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("_metadata.file_path").alias("locator"), F.col("_metadata.row_index").alias("locator_row"))
    hot = functools.cache(lambda: hot_keys(found, ["digest"], F.col("group_size")))
    rows = spread(docs.withColumn("digest", digest(F.col("text"))), found.select("digest", "keep_id", "group_size"), ["digest"], ["locator", "locator_row"], hot, "left", 128).withColumn("text_sha256", sha(F.col("text")))
    hit = rows.filter(F.col("group_size").isNotNull())
    # the content at each locator, which the bytes of every row of its digest are compared with
    where = bounded(found.select("locator", "locator_row", "digest"), 256)
    kept = written(docs.select("locator", "locator_row", F.col("text").alias("kept_text")).join(where, ["locator", "locator_row"]).select("digest", "kept_text"), "dedup-kept")
    names = ["doc_id", "digest", "text_sha256", "keep_id", "group_size"]
    differs = F.when(F.col("kept_text") != F.col("text"), F.col("text"))
    checked = written(spread(hit, kept, ["digest"], ["locator", "locator_row"], hot, "left").select(*names, differs.alias("other")), "dedup-checked")
    odd = checked.filter("other is not null").select("digest").distinct()
    if not odd.isEmpty():  # bytes differ under one digest: its rows are classed by their bytes
        again = checked.join(odd, "digest", "left_semi").groupBy("digest", "other").agg(F.max("doc_id").alias("k"), F.count("*").alias("n")).withColumnsRenamed({"digest": "d", "other": "o"})
        checked = checked.join(again, F.col("digest").eqNullSafe(F.col("d")) & F.col("other").eqNullSafe(F.col("o")), "left").withColumns({"keep_id": F.when(F.col("n").isNull(), F.col("keep_id")).otherwise(F.col("k")), "group_size": F.coalesce("n", "group_size")})
    alone = rows.filter(F.col("group_size").isNull()).withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    out = alone.select(names).unionByName(checked.select(names))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, digest=sha) -> DataFrame:
    """exact_dedup_files for any DataFrame with doc_id and text: it is written to the shared folder, then streamed."""
    spark = docs.sparkSession
    path = scratch(spark, "dedup-input")
    docs.select("doc_id", "text").write.option("compression", "zstd").parquet(path)
    return exact_dedup_files(spark, path, docs.select("doc_id", "text").schema, digest)
