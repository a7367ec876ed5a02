"""A whole run: framework, documents, prompts, batches, findings, verdicts, deliverables. Everything between the provider's records and the sinks is one lazy plan."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.operators import audit, framework, ladder, prompts, requests, responses, runs
from quotarium.settings import Settings
from quotarium.sources import documents, tables, wire
from quotarium.sources.providers import Provider
from quotarium.storage import written

log = logging.getLogger(__name__)


@dataclass
class Outcome:
    findings: DataFrame | None = None
    errors: DataFrame | None = None
    verdicts: DataFrame | None = None
    clean: DataFrame | None = None
    requests: DataFrame | None = None
    cost: DataFrame | None = None


def landed(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Records of all categories, each read from its batch's folder."""
    out = None
    for category, path in paths.items():
        own = wire.read_records(spark, path).withColumn("category", F.lit(category))
        out = own if out is None else out.unionByName(own)
    return out if out is not None else spark.createDataFrame([], f"category string, {responses.WIRE}, response_ord long")


def parse(records: DataFrame, files: DataFrame, labels: DataFrame, run_ts: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Findings and errors of wire records."""
    answers = written(responses.decoded(responses.with_filenames(responses.results(records), files), labels), "answers")
    return responses.findings(answers, run_ts), responses.errors(answers, run_ts)


def deliver(found: DataFrame, bad: DataFrame, doc_texts: DataFrame, out: str | None, settings: Settings, kind: str = "parquet") -> Outcome:
    """Verdicts once, written, since three sinks read them."""
    verdicts = written(ladder.verify(found, doc_texts, settings), "verdicts")
    paged = audit.with_pages(verdicts)
    done = Outcome(found, bad, audit.audit(paged), audit.clean(paged))
    if out:
        tables.save_findings(done.clean, f"{out}/coded_findings.{kind}")
        tables.save_audit(done.verdicts, f"{out}/coded_findings_verified.{kind}")
        tables.save_errors(bad, f"{out}/errors.{kind}")
    return done


def run(spark: SparkSession, labels: DataFrame, folder: str, provider: Provider, out: str, settings: Settings = Settings(), resume: bool = False, run_ts: str | None = None, kind: str = "parquet", blocks: DataFrame | None = None) -> Outcome:
    """labels: a validated framework. blocks: text blocks of the documents, if not to be extracted from the folder.

    The state is saved before the first and after each submission. With resume, the run's key, files and batches of the stored state are used, and only categories without a batch are
    submitted; of those the provider skips what has landed.
    """
    state_path = f"{out}/run_state.json"
    stored = (runs.load(spark, state_path) if resume else None) or runs.RunState()
    stored.run_key = provider.run_key = stored.run_key or provider.run_key
    if stored.files:
        files = spark.read.parquet(stored.files)
    elif stored.file_rows:
        rows = [(r["filename"], r["file_id"], i) for i, r in enumerate(stored.file_rows, 1)]
        files = spark.createDataFrame(rows, "filename string, file_id string, idx long")
    else:
        path = f"{out}/run_files_{stored.run_key}"
        if not settings.dry_run:
            _replace(spark, state_path, stored)  # so that a crash while files go up can be resumed, too
        provider.upload(documents.discover(spark, folder, settings.max_documents)).write.mode("overwrite").parquet(path)
        files, stored.files = spark.read.parquet(path), path
        tables.save_file_mapping(files, f"{out}/file_mapping.{kind}")
    cost = requests.cost_estimate(files, labels, settings.provider, settings.model)
    asked = prompts.analysis_prompts(labels, settings.include_confidence)
    tables.save_prompts(asked, f"{out}/prompts")
    matrix = requests.request_matrix(files, asked)
    pending = [r["category"] for r in asked.orderBy("cat_ord").collect() if r["category"] not in stored.batches]  # one row a category
    if settings.dry_run:
        return Outcome(requests=matrix, cost=cost)
    _replace(spark, state_path, stored)
    for category in pending:
        stored.batches[category] = provider.submit(category, matrix.filter(F.col("category") == category))
        stored = runs.save(spark, state_path, stored)
    paths = {c: provider.fetch(c, provider.poll(b)) for c, b in stored.batches.items()}
    found, bad = parse(landed(spark, paths), files, labels, run_ts)
    from quotarium.operators.assembly import from_blocks

    texts = from_blocks(blocks if blocks is not None else documents.blocks(spark, folder), settings)
    return replace(deliver(found, bad, texts, out, settings, kind), requests=matrix, cost=cost)


def _replace(spark: SparkSession, path: str, state: runs.RunState) -> runs.RunState:
    from quotarium.storage import write_bytes

    write_bytes(spark, path, state.to_json().encode())
    return state


def verify_files(spark: SparkSession, findings_path: str, doc_texts: DataFrame, out: str | None, settings: Settings = Settings()) -> DataFrame:
    """Verification on its own: any findings table, its columns kept, page_number replaced and the verdict added. The input stays as it is."""
    rows = tables.load_findings(spark, findings_path)
    verdicts = written(ladder.verify(rows.select("snippet_id", "finding_hash", "filename", "snippet", "finding_ord"), doc_texts, settings), "verdicts")
    result = audit.reaudit(rows, verdicts)
    if out:
        tables.save_table(result, out)
    return result


__all__ = ["Outcome", "deliver", "framework", "landed", "parse", "run", "verify_files"]
