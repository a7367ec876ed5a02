"""Steps on the shared storage: what is deleted, what stays, and where they may lie."""

import os

import pytest
from pyspark.sql import functions as F

from quotarium import storage


def path_of(df):
    return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_steps_are_deleted_but_for_what_is_kept(spark):
    df = spark.range(3)
    with storage.steps(spark) as keep:
        with storage.steps(spark) as inner:
            gone, deep = storage.written(df, "gone"), inner(storage.written(df, "deep"))
            gone_path, deep_path = path_of(gone), path_of(deep)
        assert not os.path.exists(gone_path) and os.path.exists(deep_path)
        kept = keep(storage.written(df, "kept"))
    assert not os.path.exists(deep_path) and kept.count() == 3
    with pytest.raises(ValueError), storage.steps(spark):
        lost = path_of(storage.written(df, "lost"))
        raise ValueError
    assert not os.path.exists(lost)


def test_release(spark):
    own = path_of(storage.written(spark.range(3), "own"))
    storage.release(spark)
    assert not os.path.exists(own)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError):
        storage.shared_root(Session())
    Session.sparkContext.master = "local[4]"
    assert storage.shared_root(Session()).startswith("file:///")


def test_lower_limits_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "7")
        storage.small_batches(spark)
        assert spark.conf.get(key) == "7"
        spark.conf.set(key, "10000")
        storage.small_batches(spark)
        assert spark.conf.get(key) == str(storage.BATCH_ROWS) and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") == str(storage.BATCH_BYTES)
    finally:
        spark.conf.set(key, was)


def test_steps_have_no_checksum_files_but_are_checked(spark):
    """A chmod is started for each checksum file, too. What they guard, the pages' own checksums do."""
    step = storage.written(spark.range(1000).repartition(3), "raw")
    path = path_of(step)
    assert not [f for _, _, names in os.walk(path) for f in names if f.endswith(".crc")]
    assert step.agg(F.sum("id")).first()[0] == 499_500
    part = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getsize)
    with open(part, "r+b") as f:
        f.seek(os.path.getsize(part) // 3)  # in the page's numbers
        old = f.read(1)
        f.seek(-1, os.SEEK_CUR)
        f.write(bytes([old[0] ^ 255]))
    with pytest.raises(Exception, match="(?i)checksum|crc|corrupt"):
        step.collect()
