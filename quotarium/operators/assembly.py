"""From text blocks of pages to one searchable text for each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotarium.functions.pages import assemble_blocks, assemble_lines
from quotarium.functions.text import casefold, normalize, signature, strip
from quotarium.settings import Settings
from quotarium.storage import small_batches

BLOCKS = "filename string, page_no int, block_no int, text string, y0 double, y1 double, page_height double"


def in_margin(margin: float) -> Column:
    """The block ends in the top margin or begins in the bottom one."""
    h = F.col("page_height")
    return (F.col("y1") <= h * F.lit(margin)) | (F.col("y0") >= h * F.lit(1 - margin))


def page_counts(blocks: DataFrame) -> DataFrame:
    """filename, n_pages: blank pages count too, and come as rows without text."""
    return blocks.groupBy("filename").agg(F.countDistinct("page_no").alias("n_pages"))


def boilerplate(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """filename, sig of margin texts that recur on enough pages: at least two, and at least the given share (rounded half to even). One-page documents have none."""
    signed = blocks.filter(in_margin(settings.margin) & (strip(F.coalesce("text", F.lit(""))) != "")).select("filename", "page_no", signature(F.col("text")).alias("sig"))
    pages = signed.filter("sig <> ''").groupBy("filename", "sig").agg(F.countDistinct("page_no").alias("pages"))
    least = F.greatest(F.lit(2), F.bround(F.col("n_pages") * F.lit(settings.boilerplate_share)).cast("long"))
    return pages.join(page_counts(blocks), "filename").filter((F.col("n_pages") >= 2) & (F.col("pages") >= least)).select("filename", "sig", "pages", "n_pages")


def stripped(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The blocks with text, without margin blocks whose signature is boilerplate of their document."""
    full = blocks.filter(strip(F.coalesce("text", F.lit(""))) != "")
    if not settings.strip_boilerplate:
        return full
    bad = boilerplate(blocks, settings).select("filename", "sig")
    sig = F.when(in_margin(settings.margin), signature(F.col("text")))
    return full.withColumn("sig", sig).join(bad, ["filename", "sig"], "left_anti").drop("sig")


def page_texts(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """filename, page_no, display, cf of every page, in normal form; a page with nothing left is empty."""
    kept = stripped(blocks, settings).select("filename", "page_no", "block_no", "text")
    # pages come back by a union, so one grouping does for both and no join is needed
    rows = kept.unionByName(blocks.select("filename", "page_no", F.lit(None).cast("int").alias("block_no"), F.lit(None).cast("string").alias("text")).distinct())
    ordered = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("block_no", "text"))))
    raw = rows.groupBy("filename", "page_no").agg(F.array_join(F.transform(ordered, lambda b: b["text"]), " ").alias("raw"))
    shown = raw.select("filename", "page_no", normalize(F.col("raw")).alias("display"))
    return shown.withColumn("cf", casefold(F.col("display")))


def doc_texts(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """filename, has_text_layer, full_cf, full_display, page_offsets: pages in order, one space apart."""
    before = Window.partitionBy("filename").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = pages.withColumn("start", F.coalesce(F.sum(F.length("cf") + 1).over(before), F.lit(0)).cast("int"))
    own = placed.groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("page_no", "display", "cf", "start"))).alias("p"))
    out = own.select("filename", F.array_join("p.cf", " ").alias("full_cf"), F.array_join("p.display", " ").alias("full_display"), F.col("p.start").alias("page_offsets"))
    return _with_layer(out, settings)


def _with_layer(texts: DataFrame, settings: Settings) -> DataFrame:
    layer = F.length(strip(F.col("full_cf"))) >= settings.min_text_length
    return texts.select("filename", layer.alias("has_text_layer"), "full_cf", "full_display", "page_offsets")


def from_blocks(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_texts() of page_texts() in one grouping: a document's blocks meet once, and one Arrow UDF drops what recurs and puts the rest together."""
    small_batches(blocks.sparkSession)
    marginal = F.coalesce(in_margin(settings.margin), F.lit(False))
    rows = blocks.groupBy("filename").agg(F.collect_list(F.struct("page_no", "block_no", marginal.alias("marginal"), "text")).alias("b"))
    share = F.when(F.lit(settings.strip_boilerplate) & F.col("filename").isNotNull(), F.lit(float(settings.boilerplate_share)))
    own = rows.select("filename", assemble_blocks(*[F.col(f"b.{c}") for c in ("page_no", "block_no", "marginal", "text")], share).alias("d"))
    return _with_layer(own.select("filename", "d.*"), settings)


def page_at(offsets: Column, place: Column) -> Column:
    """Number of the page that a place lies on: how many pages start at or before it; null without pages or place."""
    return F.nullif(F.size(F.filter(offsets, lambda o: o <= place)), F.lit(0)).cast("long")


def texts_as_documents(docs: DataFrame, filename: Column, settings: Settings = Settings()) -> DataFrame:
    """doc_texts() of plain texts whose lines are their pages, without a shuffle: a text's lines are in its row already."""
    small_batches(docs.sparkSession)
    rows = docs.select(filename.alias("filename"), assemble_lines(F.col("text")).alias("d"))
    return _with_layer(rows.select("filename", "d.*"), settings)
