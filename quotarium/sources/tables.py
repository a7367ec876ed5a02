"""Small hand-written tables in and deliverables out: xlsx, csv, JSON lines or Parquet, by the path's suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.operators import framework
from quotarium.settings import AUDIT_COLUMNS, ERROR_COLUMNS, FINDING_COLUMNS
from quotarium.sources.xlsx import read_sheet, write_sheet
from quotarium.storage import filesystem, write_bytes

#: A spreadsheet is made on the driver; beyond this many rows a deliverable must be Parquet, csv or JSON.
LARGEST_SHEET = 1_000_000


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Any table file as text columns (Parquet keeps its types)."""
    kind = path.lower().rpartition(".")[2]
    if kind == "xlsx":
        columns, rows = read_sheet(read_bytes(spark, path))
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{c}` string" for c in columns))
    if kind == "csv":
        return spark.read.csv(path, header=True, multiLine=True, escape='"')
    return spark.read.json(path) if kind in ("json", "jsonl") else spark.read.parquet(path)


def load_framework(spark: SparkSession, path: str) -> DataFrame:
    """The validated framework of a sheet, which is written by hand and read on the driver."""
    if path.lower().endswith(".xlsx"):
        columns, rows = read_sheet(read_bytes(spark, path))
    else:
        t = read_table(spark, path)
        columns, rows = t.columns, [list(r) for r in t.collect()]
    return framework.validated(framework.from_rows(spark, columns, rows))


def load_findings(spark: SparkSession, path: str) -> DataFrame:
    """Any findings table; the four columns that verification needs are there, empty where the file lacks them, and finding_ord gives the file's order."""
    t = read_table(spark, path)
    for c in ("snippet_id", "finding_hash", "filename", "snippet"):
        t = t.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")) if c in t.columns else F.lit(""))
    return t.withColumn("finding_ord", F.monotonically_increasing_id())


def save_table(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, order: str | None = "finding_ord") -> None:
    """Columns in their order; a header even without rows. Sorted only here, at the sink."""
    rows = df.orderBy(order) if order and order in df.columns else df
    rows = rows.select(*(columns or [c for c in df.columns if c != order]))
    kind = path.lower().rpartition(".")[2]
    if kind == "xlsx":
        own = rows.limit(LARGEST_SHEET + 1).collect()
        if len(own) > LARGEST_SHEET:
            raise ValueError(f"{path}: a sheet holds at most {LARGEST_SHEET} rows; write Parquet, csv or JSON instead")
        write_bytes(df.sparkSession, path, write_sheet(rows.columns, [tuple(r) for r in own]))
    elif kind == "csv":
        rows.write.mode("overwrite").csv(path, header=True, escape='"')
    elif kind in ("json", "jsonl"):
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_findings(df: DataFrame, path: str) -> None:
    save_table(df, path, FINDING_COLUMNS)


def save_errors(df: DataFrame, path: str) -> None:
    save_table(df, path, ERROR_COLUMNS)


def save_audit(df: DataFrame, path: str) -> None:
    save_table(df, path, (*FINDING_COLUMNS, *AUDIT_COLUMNS))


def save_file_mapping(df: DataFrame, path: str) -> None:
    save_table(df, path, ("filename", "file_id"), "idx")


def load_file_mapping(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).select("filename", "file_id")


def save_prompts(prompts: DataFrame, folder: str) -> None:
    """A text file for each category, as it was sent."""
    from quotarium.functions.ids import prompt_file_part

    for r in prompts.select(prompt_file_part(F.col("category")).alias("part"), "prompt").collect():  # one row a category
        write_bytes(prompts.sparkSession, f"{folder}/prompt_used__{r['part']}.txt", r["prompt"].encode())
