"""Arrow UDFs that put the pages of a document together: normal forms, the joined texts and where each page starts."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotarium.functions.text import normalize_text

_DIGITS = re.compile(r"\d+")
_TYPE = pa.struct([("full_cf", pa.string()), ("full_display", pa.string()), ("page_offsets", pa.list_(pa.int32()))])


def assemble(pages: list[str]) -> dict:
    """Pages are normalised one by one and joined by a space, so an empty page leaves two spaces."""
    display = [normalize_text(p) for p in pages]
    cf = [d.casefold() for d in display]
    starts = list(accumulate([len(c) + 1 for c in cf], initial=0))[:-1]
    return {"full_cf": " ".join(cf), "full_display": " ".join(display), "page_offsets": starts}


_ASSEMBLED = T.StructType().add("full_cf", T.StringType()).add("full_display", T.StringType()).add("page_offsets", T.ArrayType(T.IntegerType()))


def assemble_document(page_no: list[int | None], block_no: list[int | None], marginal: list[bool], text: list[str | None], share: float | None) -> dict:
    """assemble() of a document's blocks, without margin blocks whose signature recurs on at least two pages and that share of them; no share: all blocks stay. Blank blocks make pages, too."""
    own = [(p is not None, p or 0, b is not None, b or 0, t, m) for p, b, m, t in zip(page_no, block_no, marginal, text) if t and not t.isspace()]
    sigs: dict[str, str] = {}
    bad: set[str] = set()
    if share is not None:
        pages_of = defaultdict(set)
        for known, p, *_, t, m in own:
            if m:
                if t not in sigs:
                    sigs[t] = _DIGITS.sub("#", normalize_text(t, True)).strip(" ")
                if known:
                    pages_of[sigs[t]].add(p)
        n = len({p for p in page_no if p is not None})
        bad = {s for s, on in pages_of.items() if s and n >= 2 and len(on) >= max(2, round(n * share))}
    pages: dict[tuple, list[str]] = {(p is not None, p or 0): [] for p in page_no}
    for *at, t, m in sorted(own, key=lambda x: x[:5]):
        if not (m and sigs.get(t) in bad):
            pages[at[0], at[1]].append(t)
    return assemble([" ".join(pages[k]) for k in sorted(pages)])


@F.arrow_udf(_ASSEMBLED)
def assemble_blocks(page_no: pa.Array, block_no: pa.Array, marginal: pa.Array, text: pa.Array, share: pa.Array) -> pa.Array:
    """A row a document: its blocks' numbers, places and texts, in any order."""
    rows = zip(*(c.to_pylist() for c in (page_no, block_no, marginal, text, share)))
    return pa.array([assemble_document(*r) for r in rows], _TYPE)


@F.arrow_udf(_ASSEMBLED)
def assemble_lines(col: pa.Array) -> pa.Array:
    """Each line of a text is a page."""
    return pa.array([assemble((t or "").split("\n")) for t in col.to_pylist()], _TYPE)


# Spark would run them once more below each filter on what they give, in a second Python worker of each task; it leaves what it holds for nondeterministic where it is.
assemble_blocks, assemble_lines = assemble_blocks.asNondeterministic(), assemble_lines.asNondeterministic()
