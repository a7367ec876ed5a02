"""Model answers: cleaning in the JVM, strict decoding in one Arrow UDF.

Spark's JSON readers accept text after a document and reject NaN, and casts print values unlike the answers' contract; so the standard
library decodes, and everything after it is DataFrame operations.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotarium.functions.text import SPACE, strip

_FIELDS = ("kind", "label_code", "snippet", "reasoning", "confidence", "raw")
_ITEM = pa.struct([("pos", pa.int32()), *[(k, pa.string()) for k in _FIELDS]])
_TYPE = pa.struct([("error", pa.string()), ("kind", pa.string()), ("items", pa.list_(_ITEM))])
DECODED = T.StructType().add("error", T.StringType()).add("kind", T.StringType()).add("items", T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), *[T.StructField(k, T.StringType()) for k in _FIELDS]])))


def clean_json_text(text: Column) -> Column:
    """Takes off a code fence and what stands before the first brace."""
    text = F.regexp_replace(strip(text), f"^```(?:json)?{SPACE}*", "")
    text = F.regexp_replace(strip(text), f"\n?```{SPACE}*$", "")
    brace = F.instr(text, "{")
    return strip(F.when(brace > 1, F.substr(text, brace)).otherwise(text))


def _whole(value: str | None) -> str:
    """Lone surrogates, which JSON escapes can spell and UTF-8 can't, become question marks."""
    return value.encode("utf-8", "replace").decode()


def decode(text: str) -> dict:
    """error: the decoder's message; kind: list, or the type found in its place; items: the elements, those that are objects with their fields as text."""
    try:
        doc = json.loads(text)
    except (ValueError, RecursionError) as e:
        return {"error": str(e) or type(e).__name__, "kind": None, "items": None}
    if not isinstance(doc, dict):
        return {"error": None, "kind": f"top:{type(doc).__name__}", "items": None}
    found = doc.get("findings", [])
    if not isinstance(found, list):
        return {"error": None, "kind": type(found).__name__, "items": None}
    items = []
    for pos, x in enumerate(found):
        item = {"pos": pos, "kind": type(x).__name__}
        if isinstance(x, dict):
            item |= {k: _whole(str(x.get(k, "")).strip()) for k in ("label_code", "snippet", "reasoning")}
            item |= {"confidence": _whole(str(x.get("confidence", "")).strip().lower()), "raw": _whole(json.dumps(x, ensure_ascii=False)[:500])}
        items.append(item)
    return {"error": None, "kind": "list", "items": items}


@F.arrow_udf(DECODED)
def decode_answer(col: pa.Array) -> pa.Array:
    return pa.array([None if t is None else decode(t) for t in col.to_pylist()], _TYPE)
