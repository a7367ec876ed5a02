"""Bounded samples of labelled rows for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotarium.llm.common import bounded, written

_RING = 1 << 30
#: With many classes, each still has about this many rows.
_LEAST = 16


def per_class(rows: DataFrame, label: str, key: str, bound: int, salt: str, total: int | None = None) -> DataFrame:
    """About `bound` rows of each class (all of a smaller one), by a hash of the key: the same rows in every run and for any partitioning.

    With `total`, the bound falls as classes grow in number, so that all together have about `total` rows, and no class has over twice its bound, even if its keys are
    null or repeat.
    """
    counts = written(rows.groupBy(label).agg(F.count("*").alias("class_rows")), "classes")
    small = lambda df: bounded(df, 96)  # noqa: E731  labels may be many
    place = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(_RING))
    if total is None:
        return rows.join(small(counts), label).filter(place < F.lit(float(_RING)) * bound / F.col("class_rows")).drop("class_rows")
    each = F.greatest(F.lit(_LEAST), F.floor(total / F.count("*").over(Window.partitionBy())))
    counts = written(counts.withColumn("class_bound", F.least(F.lit(bound), each)), "classes")
    some = rows.join(small(counts), label).filter(place < F.lit(float(_RING)) * F.col("class_bound") / F.col("class_rows"))
    some = some.withColumn("class_place", F.row_number().over(Window.partitionBy(label).orderBy(place, F.xxhash64(*rows.columns))))
    return some.filter(F.col("class_place") <= 2 * F.col("class_bound")).drop("class_rows", "class_bound", "class_place")
