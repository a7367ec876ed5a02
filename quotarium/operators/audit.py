"""What becomes of verdicts: page numbers, the clean table, the audit table and summaries."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotarium.settings import AUDIT_COLUMNS, FINDING_COLUMNS, NOT_FOUND, VERIFIED_GROUP
from quotarium.storage import small_batches


@F.arrow_udf(T.DoubleType())
def _one_digit(col: pa.Array) -> pa.Array:
    return pa.array([None if x is None else round(x, 1) for x in col.to_pylist()], pa.float64())


def _shown(verdicts: DataFrame) -> DataFrame:
    """Scores to one digit as the binary value rounds (only scores between 0 and 100 go to Python), matched text to 2000 characters."""
    small_batches(verdicts.sparkSession)
    part = F.when((F.col("match_score") > 0) & (F.col("match_score") < 100), F.col("match_score"))
    return verdicts.withColumns({"match_score": F.coalesce(_one_digit(part), "match_score"), "matched_text": F.substring("matched_text", 1, 2000)})


def last_by_id(verdicts: DataFrame, order: str = "finding_ord") -> DataFrame:
    """One verdict for each snippet_id: the last in order. Ids can collide; the last one counts."""
    cols = [c for c in (*AUDIT_COLUMNS, "page_number") if c in verdicts.columns]
    return verdicts.groupBy("snippet_id").agg(F.max_by(F.struct(*cols), order).alias("v")).select("snippet_id", "v.*")


def with_pages(verdicts: DataFrame) -> DataFrame:
    """Verdicts with page_number taken by snippet_id from the last verdict of that id."""
    pages = last_by_id(verdicts).select("snippet_id", F.col("page_number").alias("last_page"))
    return verdicts.join(pages, "snippet_id").withColumn("page_number", F.col("last_page")).select(*verdicts.columns)


def clean(verdicts: DataFrame) -> DataFrame:
    """Findings without those whose id has a verdict not_found; everything else stays, for a person to look at."""
    gone = verdicts.filter(F.col("verification_status") == NOT_FOUND).select("snippet_id").distinct()
    return verdicts.join(gone, "snippet_id", "left_anti").select(*_there(verdicts, FINDING_COLUMNS))


def audit(verdicts: DataFrame) -> DataFrame:
    """Every finding with its own verdict."""
    own = _shown(verdicts)
    return own.select(*_there(own, (*FINDING_COLUMNS, *AUDIT_COLUMNS)))


def _there(df: DataFrame, names) -> list[str]:
    return [c for c in (*names, "finding_ord") if c in df.columns]


def status_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verification_status").agg(F.count("*").alias("n"))


def verified_ratio(verdicts: DataFrame) -> DataFrame:
    """n_verified, n_findings, ratio (null without findings)."""
    out = verdicts.agg(F.count_if(F.col("verification_status").isin(*VERIFIED_GROUP)).alias("n_verified"), F.count("*").alias("n_findings"))
    return out.withColumn("ratio", F.when(F.col("n_findings") > 0, F.col("n_verified") / F.col("n_findings")))


def run_summary(findings: DataFrame, errors: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row: n_findings, n_errors, n_verified, n_not_found."""
    v = verdicts.agg(F.count_if(F.col("verification_status").isin(*VERIFIED_GROUP)).alias("n_verified"), F.count_if(F.col("verification_status") == NOT_FOUND).alias("n_not_found"))
    return findings.agg(F.count("*").alias("n_findings")).crossJoin(errors.agg(F.count("*").alias("n_errors"))).crossJoin(v)


def reaudit(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Any findings table, with page_number replaced and the four audit columns added by snippet_id, last verdict first; other columns stay."""
    kept = [c for c in rows.columns if c not in (*AUDIT_COLUMNS, "page_number")]
    last = _shown(last_by_id(verdicts))
    return rows.select(*kept).join(last, "snippet_id", "left").select(*kept, "page_number", *AUDIT_COLUMNS)
