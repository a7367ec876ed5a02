"""What the operators share: folders on the cluster's storage, written steps, small Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.storage import discard, scratch, shared_root, small_batches, steps, written

__all__ = ["ascii_lower", "bounded", "discard", "fits", "held_out", "hot_keys", "pick", "scratch", "shared_root", "small_batches", "spread", "steps", "table", "written"]


def fits(df: DataFrame, row_bytes: int, limit: int = 24 << 20) -> bool:
    """Whether a table's counted rows are few enough to be sent to every task."""
    return df.count() * row_bytes <= limit


def bounded(df: DataFrame, row_bytes: int, limit: int = 24 << 20) -> DataFrame:
    """Marks a written table for broadcast only if its counted rows fit a limit; else joins shuffle it."""
    return F.broadcast(df) if fits(df, row_bytes, limit) else df


#: Keys with more rows than this are dealt over several tasks, so many at most; the next largest key after HOT_KEYS others can't hold more than a HOT_KEYS-th of all rows.
HOT_ROWS, HOT_KEYS, SHARES = 1024, 50_000, 1000


def hot_keys(rows: DataFrame, on: list[str], n: Column | None = None) -> DataFrame | None:
    """The keys of a written table that hold very many rows (or the sum of n), and over how many shares each is dealt; None if there are none.

    There are HOT_KEYS at most, so the driver may hold them and they may be broadcast.
    """
    counts = rows.groupBy(*on).agg((F.count("*") if n is None else F.sum(n)).alias("key_rows")).filter(F.col("key_rows") > HOT_ROWS)
    shares = counts.orderBy(F.col("key_rows").desc()).limit(HOT_KEYS).select(*on, F.least(F.ceil(F.col("key_rows") / HOT_ROWS), F.lit(SHARES)).cast("int").alias("shares"))
    got = shares.collect()
    return F.broadcast(rows.sparkSession.createDataFrame(got, shares.schema)) if got else None


def spread(left: DataFrame, right: DataFrame, on: list[str], by: list[str], hot: Callable[[], DataFrame | None], how: str = "inner", row_bytes: int | None = None) -> DataFrame:
    """left.join(right, on) in which no task gets all rows of a hot key on the left.

    If the right rows, of so many bytes each, are few enough, they are broadcast and the left rows stay where they are. Else the rows of hot keys are dealt by a hash of `by`, and each share has its
    own copy of the right rows.
    """
    if row_bytes and fits(right, row_bytes):
        return left.join(F.broadcast(right), on, how)
    if (keys := hot()) is None:
        return left.join(right, on, how)
    shares = F.coalesce("shares", F.lit(1))
    dealt = left.join(keys, on, "left").withColumn("share", F.pmod(F.xxhash64(*by), shares).cast("int")).drop("shares")
    copies = right.join(keys, on, "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("shares")
    return dealt.join(copies, [*on, "share"], how).drop("share")


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator reads: others, of whatever name, can't clash with its own."""
    return docs.select(*[docs[n] for n in names])


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, everything else as it is. Null stays null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
