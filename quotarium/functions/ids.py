"""Identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _clean(text: Column, pattern: str = "[^A-Za-z0-9_-]") -> Column:
    return F.regexp_replace(text, pattern, "_")


def _short(text: Column, n: int) -> Column:
    return F.regexp_replace(F.substring(_clean(text), 1, n), "^_+|_+$", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(filename: Column) -> Column:
    """The name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(basename(filename), r"(?<=.)\.[^.]+$", "")


def custom_id(filename: Column, idx: Column) -> Column:
    """Identifier of a request: req-, the number of at least 4 digits, and the cleaned name, 64 characters at most."""
    return F.substring(F.concat(F.lit("req-"), F.format_string("%04d", idx.cast("long")), F.lit("-"), _clean(filename)), 1, 64)


def snippet_id(filename: Column, category: Column, seq: Column) -> Column:
    return F.concat(_short(stem(filename), 40), F.lit("__"), _short(category, 30), F.lit("__"), F.format_string("%04d", seq.cast("long")))


def finding_hash(filename: Column, category: Column, code: Column, snippet: Column) -> Column:
    """First 16 hex digits of the SHA-256 over the four parts."""
    parts = [F.coalesce(c, F.lit("")) for c in (filename, category, code, snippet)]
    return F.left(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), F.lit(16))


def prompt_file_part(category: Column) -> Column:
    return _short(category, 60)


def iso_seconds(run_ts: str | None) -> Column:
    """The stamp of a run: given, or now."""
    return F.lit(run_ts) if run_ts else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
