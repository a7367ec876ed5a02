"""Text normalisation as column expressions.

ASCII texts stay in the JVM. Other texts go through one Arrow UDF, since Spark has neither NFKC nor case folding; the
UDF gets null for ASCII rows, so nothing but the texts that need it crosses to Python.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that are folded after NFKC.
FOLDED = {
    "'": "\u2018\u2019\u201a\u201b\u2032",
    '"': "\u201c\u201d\u201e\u201f\u2033",
    "-": "\u2010\u2011\u2012\u2013\u2014\u2015\u2212",
    "...": "\u2026",
    " ": "\u00a0\u2007\u202f\u2009\u200a",
    "": "\u200b\u200c\u200d\ufeff\u00ad",
}
# A word broken over lines; white space; marks of an elision.
BROKEN_WORD = r"(\w)-[ \t]*\n[ \t]*(\w)"
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
ELISION = r"\s*(?:\[\s*\.\.\.\s*\]|\.\s*\.\s*\.)\s*"

_TABLE = str.maketrans({c: to for to, chars in FOLDED.items() for c in chars})
_BROKEN, _ELISION = re.compile(BROKEN_WORD), re.compile(ELISION)


def normalize_text(text: str | None, fold: bool = False) -> str:
    """The normal form of one text; null is empty."""
    flat = _BROKEN.sub(r"\1\2", unicodedata.normalize("NFKC", text or "").translate(_TABLE))
    flat = " ".join(flat.split())
    return flat.casefold() if fold else flat


def split_fragments(snippet: str | None) -> list[str]:
    """The non-blank pieces between elision marks of a raw snippet."""
    return [p for p in _ELISION.split(snippet or "") if p.strip()]


@F.arrow_udf(T.StringType())
def _plain(col: pa.Array) -> pa.Array:
    return pa.array([None if t is None else normalize_text(t) for t in col.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _folded(col: pa.Array) -> pa.Array:
    return pa.array([None if t is None else normalize_text(t, True) for t in col.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _casefolded(col: pa.Array) -> pa.Array:
    return pa.array([None if t is None else t.casefold() for t in col.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _fragments(col: pa.Array) -> pa.Array:
    return pa.array([None if t is None or len(p := split_fragments(t)) < 2 else [normalize_text(x, True) for x in p] for t in col.to_pylist()], pa.list_(pa.string()))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _ascii_normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, BROKEN_WORD, "$1$2"), r"[\s\x0b\x1c-\x1f]+", " "))


def normalize(text: Column, fold: bool = False) -> Column:
    """Compatibility composed, quotes, dashes and spaces folded, broken words joined, white space collapsed; with fold, case-folded too. Null is empty."""
    text = F.coalesce(text, F.lit(""))
    own = _ascii_normal(text)
    rest = (_folded if fold else _plain)(F.when(~is_ascii(text), text))
    return F.when(is_ascii(text), F.lower(own) if fold else own).otherwise(rest)


def casefold(text: Column) -> Column:
    """A normal form, case-folded: normalize(x, fold=True) of what normalize(x) gives."""
    return F.when(is_ascii(text), F.lower(text)).otherwise(_casefolded(F.when(~is_ascii(text), text)))


def fragments(snippet: Column) -> Column:
    """Normalised pieces of a snippet with elisions; null if there are fewer than two."""
    return _fragments(F.when(snippet.rlike(r"\.\s*\.\s*\."), snippet))


def signature(text: Column) -> Column:
    """What recurring headers and footers have in common: normal form with runs of digits as #."""
    return F.trim(F.regexp_replace(normalize(text, fold=True), r"\p{Nd}+", "#"))


def strip(text: Column) -> Column:
    """Unlike trim, takes all white space off both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")
