"""Folders that driver and executors share, steps written there, and what becomes of them."""

from __future__ import annotations

import contextlib
import functools
import io
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession

#: Folders of this process, by application; those of the innermost steps().
_all: dict[str, list[str]] = {}
_inner: ContextVar[list | None] = ContextVar("steps", default=None)


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="quotarium-")


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a local folder, but only if all executors are in this process."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (root or f"file://{_own_root()}").rstrip("/")


def _made(spark: SparkSession, path: str, step: DataFrame | None) -> None:
    _all.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (own := _inner.get()) is not None:
        own.append((path, step))


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_root(spark)}/{what}-{uuid.uuid4().hex}"
    _made(spark, path, None)
    return path


#: Hadoop's local file systems start a chmod for each file and folder, and until that command is loaded it shares all memory of the executor that started it, so whoever sums up processes
#: may count the executor twice. The raw one has no checksum files, so it starts a third fewer; pages are checked as they are read instead.
_RAW = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_CHECKED = {"parquet.page.verify-checksum.enabled": "true"}


def written(df: DataFrame, what: str) -> DataFrame:
    """Writes a step as Parquet and reads it back: lineage ends there, and a lost executor costs one task."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **_RAW).parquet(path)
    step = spark.read.options(**_CHECKED).schema(df.schema).parquet(path)
    _made(spark, path, step)
    return step


@contextlib.contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Folders made inside are deleted at its end, but for the written steps that are handed to what it yields: a result may still read those."""
    made: list = []
    kept: list[DataFrame] = []

    def keep(step: DataFrame) -> DataFrame:
        kept.append(step)
        return step

    outer = _inner.get()
    token = _inner.set(made)
    try:
        yield keep
    finally:
        _inner.reset(token)
        stay = {id(k) for k in kept}
        if outer is not None:
            outer.extend(x for x in made if id(x[1]) in stay)
        discard(spark, *[path for path, step in made if id(step) not in stay])


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes folders of the shared storage that nothing reads any more."""
    own = _all.get(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, p = filesystem(spark, path)
        fs.delete(p, True)
        if path in own:
            own.remove(path)


def release(spark: SparkSession) -> None:
    """Deletes every folder that this session's queries have left. Their results can't be read after that, so save or collect them first."""
    discard(spark, *list(_all.get(spark.sparkContext.applicationId, [])))


#: Rows and bytes that a Python worker gets at once.
BATCH_ROWS, BATCH_BYTES = 512, 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once; a longer text is a batch of its own. Plans are lazy, so the session's limits are lowered once, to the same values by all
    operators; limits that are lower already stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system and path of a string, so any store that Spark reaches is reached. Local files are kept without checksum files, since people edit them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    local = is_instance_of(spark.sparkContext._gateway, fs, "org.apache.hadoop.fs.LocalFileSystem")
    return (fs.getRaw() if local else fs), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of a store, or None if there is none."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes beside the target, then renames: a reader sees the old file or the new one."""
    write_stream(spark, path, io.BytesIO(content))


def write_stream(spark: SparkSession, path: str, source, block: int = 1 << 20) -> None:
    """write_bytes() of all that a reader gives, block by block."""
    fs, target = filesystem(spark, path)
    fs.mkdirs(target.getParent())
    _, temp = filesystem(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, True)
    while part := source.read(block):
        stream.write(bytearray(part))
    stream.close()
    if not fs.rename(temp, target):  # stores that don't rename onto a file
        fs.delete(target, False)
        if not fs.rename(temp, target):
            raise OSError(f"can't write {path}")
