"""Documents of a folder, and adapters that take text blocks out of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.functions.ids import basename
from quotarium.operators.assembly import BLOCKS
from quotarium.operators.requests import documents, suffix
from quotarium.sources.office import slide_blocks, word_blocks
from quotarium.storage import small_batches

#: (content) -> [(page_no, block_no, text, y0, y1, page_height)], by suffix. PDF and the old binary office formats need a library of the user's.
Extractor = Callable[[bytes], list[tuple[int, int, str, float, float, float]]]


#: Rows of blocks that go back to Spark at once.
LARGEST_FRAME = 10_000


def text_blocks(content: bytes) -> list[tuple[int, int, str, float, float, float]]:
    """Plain text: form feeds part pages, blank lines part blocks."""
    out = []
    for p, page in enumerate(content.decode("utf-8", "replace").split("\f"), 1):
        blocks = [b for b in page.split("\n\n") if b.strip()]
        out += [(p, k, b, 100.0 + k, 101.0 + k, 792.0 + len(blocks)) for k, b in enumerate(blocks)] or [(p, 0, None, 0.0, 0.0, 792.0)]
    return out


def pdf_blocks(content: bytes) -> list[tuple[int, int, str, float, float, float]]:
    """Needs PyMuPDF, which isn't part of this library."""
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("PDF files need PyMuPDF: give the extractor of another library, or a table of blocks") from e
    out = []
    with pymupdf.open(stream=content, filetype="pdf") as doc:
        for p, page in enumerate(doc, 1):
            own = [(p, k, b[4], float(b[1]), float(b[3]), float(page.rect.height)) for k, b in enumerate(page.get_text("blocks")) if b[6] == 0 and b[4].strip()]
            out += own or [(p, 0, None, 0.0, 0.0, float(page.rect.height))]
    return out


def no_office(content: bytes):
    raise RuntimeError("old binary office files must be converted first: register an extractor for them")


EXTRACTORS: dict[str, Extractor] = {".pdf": pdf_blocks, ".txt": text_blocks, ".docx": word_blocks, ".pptx": slide_blocks, ".doc": no_office, ".ppt": no_office}


def discover(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """path, filename, idx of the documents right in a folder, by path. A limit counts documents before anything is converted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path")
    found = documents(files, limit)
    if limit is None and found.isEmpty():
        raise FileNotFoundError(f"no documents in {folder}")
    return found


def blocks(spark: SparkSession, folder: str, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    """Text blocks of all documents of a folder that an extractor is known for; each file is read by the task that parses it."""
    known = EXTRACTORS | (extractors or {})
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    rows = files.filter(suffix(F.col("path")).isin(*known)).select(basename(F.col("path")).alias("filename"), suffix(F.col("path")).alias("kind"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_no", "block_no", "text", "y0", "y1", "page_height"]
        for b in batches:
            for name, kind, content in zip(b["filename"], b["kind"], b["content"]):
                own = pd.DataFrame(known[kind](bytes(content)), columns=names)
                own.insert(0, "filename", name)
                for a in range(0, len(own), LARGEST_FRAME):
                    yield own.iloc[a : a + LARGEST_FRAME]

    small_batches(spark)
    return rows.mapInPandas(run, BLOCKS)
