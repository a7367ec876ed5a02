"""The coding framework: loading, validation, grouping and prompt blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotarium.functions.text import strip

# The columns of a framework.
REQUIRED, OPTIONAL = ("category", "code", "description", "inclusion_criteria"), ("exclusion_criteria",)
SCHEMA = "category string, code string, description string, inclusion_criteria string, exclusion_criteria string, ord long"


class FrameworkError(ValueError):
    """A framework that can't be used, with what is wrong."""


def header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def from_rows(spark: SparkSession, columns: list[str], rows: list[list]) -> DataFrame:
    """A raw framework of text cells (null: empty) in file order, with cleaned headers."""
    names = [header(c) for c in columns]
    if missing := [c for c in REQUIRED if c not in names]:
        raise FrameworkError(f"missing columns {missing}; found {names}")
    at = {c: names.index(c) for c in (*REQUIRED, *OPTIONAL) if c in names}
    cell = lambda r, c: "" if c not in at or at[c] >= len(r) or r[at[c]] is None else str(r[at[c]])
    return spark.createDataFrame([(*[cell(r, c) for c in (*REQUIRED, *OPTIONAL)], i) for i, r in enumerate(rows)], SCHEMA)


def blanks(raw: DataFrame) -> DataFrame:
    """column, row (as a spreadsheet counts it) of each blank required cell."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), strip(F.col(c)).alias("value")) for c in REQUIRED]))
    return raw.select((F.col("ord") + 2).alias("row"), cells.alias("c")).filter("c.value = ''").select("c.column", "row")


def duplicates(raw: DataFrame) -> DataFrame:
    """category, code, n of each pair that occurs more than once."""
    return raw.groupBy(strip(F.col("category")).alias("category"), strip(F.col("code")).alias("code")).agg(F.count("*").alias("n")).filter("n > 1")


def validated(raw: DataFrame) -> DataFrame:
    """The trimmed framework, or FrameworkError that says which cells or pairs are wrong."""
    if bad := blanks(raw).orderBy("column", "row").collect():
        raise FrameworkError("blank cells: " + ", ".join(f"{b['column']} in row {b['row']}" for b in bad))
    if bad := duplicates(raw).orderBy("category", "code").collect():
        raise FrameworkError("pairs that occur twice or more: " + ", ".join(f"{b['category']} / {b['code']}" for b in bad))
    return raw.select(*[strip(F.col(c)).alias(c) for c in (*REQUIRED, *OPTIONAL)], "ord")


def categories(framework: DataFrame) -> DataFrame:
    """category, cat_ord (from 1, by first appearance), n_codes, codes (in file order)."""
    own = framework.groupBy("category").agg(F.min("ord").alias("first"), F.count("*").alias("n_codes"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "code"))), lambda x: x["code"]).alias("codes"))
    return own.select("category", F.row_number().over(Window.orderBy("first")).cast("long").alias("cat_ord"), "n_codes", "codes")


def valid_codes(framework: DataFrame) -> DataFrame:
    return framework.select("category", "code").distinct()


def prompt_block() -> Column:
    """What a prompt says of one label; exclusions only where there are any."""
    excluded = F.when(F.col("exclusion_criteria") != "", F.concat(F.lit("\n  Exclude: "), F.col("exclusion_criteria"))).otherwise("")
    return F.concat(F.lit("- "), F.col("code"), F.lit(": "), F.col("description"), F.lit("\n  Include: "), F.col("inclusion_criteria"), excluded)


def prompt_blocks(framework: DataFrame) -> DataFrame:
    """category, cat_ord, n_codes, blocks (joined by newlines in file order)."""
    blocks = framework.groupBy("category").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", prompt_block().alias("block")))), lambda x: x["block"]), "\n").alias("blocks"))
    return categories(framework).join(blocks, "category").select("category", "cat_ord", "n_codes", "blocks")
