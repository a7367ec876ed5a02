"""The state of a run: which files were handed in and which category has which batch. It is saved right after a batch is submitted and merged with what is stored, so a crash loses nothing."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.storage import read_text, write_bytes


@dataclass
class RunState:
    #: Files of a state that another tool wrote; ours are a table, whose path is in files.
    file_rows: list[dict] = field(default_factory=list)
    batches: dict[str, str] = field(default_factory=dict)
    files: str | None = None
    run_key: str | None = None

    def to_json(self) -> str:
        more = {k: v for k, v in (("files", self.files), ("run_key", self.run_key)) if v}
        return json.dumps({"file_rows": self.file_rows, "batches": [{"category": c, "batch_id": b} for c, b in self.batches.items()], **more}, ensure_ascii=False, indent=2)

    @classmethod
    def from_json(cls, text: str) -> RunState:
        d = json.loads(text)
        files = [{"filename": r["filename"], "file_id": r["file_id"]} for r in d.get("file_rows", [])]
        return cls(files, {b["category"]: b["batch_id"] for b in d.get("batches", [])}, d.get("files"), d.get("run_key"))  # the last of equal categories counts

    def merged(self, newer: RunState) -> RunState:
        return RunState(newer.file_rows or self.file_rows, self.batches | newer.batches, newer.files or self.files, newer.run_key or self.run_key)


def save(spark: SparkSession, path: str, state: RunState) -> RunState:
    """Merges with the stored state, then replaces the file in one step."""
    out = (load(spark, path) or RunState()).merged(state)
    write_bytes(spark, path, out.to_json().encode())
    return out


def load(spark: SparkSession, path: str) -> RunState | None:
    text = read_text(spark, path)
    return None if text is None else RunState.from_json(text)


def state_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored state as DataFrames: (filename, file_id) and (category, batch_id); missing lists are empty."""
    raw = spark.read.schema("file_rows array<struct<filename: string, file_id: string>>, batches array<struct<category: string, batch_id: string>>").json(path, multiLine=True)
    return raw.select(F.inline("file_rows")), raw.select(F.inline("batches"))


def plan(categories: DataFrame, batches: DataFrame) -> DataFrame:
    """category, cat_ord, batch_id (null: to be submitted); of several batches of a category the last row counts. batches: category, batch_id, ord."""
    last = batches.groupBy("category").agg(F.max_by("batch_id", "ord").alias("batch_id"))
    return categories.select("category", "cat_ord").join(last, "category", "left")


def pending(categories: DataFrame, batches: DataFrame) -> DataFrame:
    return categories.select("category", "cat_ord").join(batches.select("category").distinct(), "category", "left_anti")
