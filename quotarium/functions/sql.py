"""The engine's functions for users of SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotarium.functions.alignment import partial_alignment
from quotarium.functions.answers import decode_answer
from quotarium.functions.text import normalize_text

_ALIGNED = pa.struct([("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])


@F.arrow_udf(T.StringType())
def quote_normal(col: pa.Array) -> pa.Array:
    """Normal form, case kept; null is empty."""
    return pa.array([normalize_text(t) for t in col.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def quote_fold(col: pa.Array) -> pa.Array:
    """Normal form, case-folded; null is empty."""
    return pa.array([normalize_text(t, True) for t in col.to_pylist()], pa.string())


@F.arrow_udf(T.StructType().add("score", T.DoubleType()).add("start", T.IntegerType()).add("end", T.IntegerType()))
def quote_align(needle: pa.Array, text: pa.Array) -> pa.Array:
    """Best alignment of a folded quote in a folded text; null if either is."""
    pairs = zip(needle.to_pylist(), text.to_pylist())
    return pa.array([None if n is None or t is None else partial_alignment(n, t)._asdict() for n, t in pairs], _ALIGNED)


def register(spark: SparkSession) -> None:
    """quote_normal(text), quote_fold(text), quote_align(needle, text) and decode_answer(json) in SQL."""
    for name, f in {"quote_normal": quote_normal, "quote_fold": quote_fold, "quote_align": quote_align, "decode_answer": decode_answer}.items():
        spark.udf.register(name, f)
