import struct

import pytest
from compare import connect, differences

from quotarium.llm import queries, warc


def test_like_sql(spark, sf_dir):
    assert differences(queries.op4_warc(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op4_warc"]) is None


def test_bundle_is_valid_and_seekable():
    import zstandard

    records = [(i, warc.make_record(i, f"http://x/{i}", b"p" * (i * 37), "d", "response", None)) for i in range(300)]
    bundle = warc.make_bundle(records, 4096) + warc.SEEK_MAGIC
    frames, index = warc.read_index(bundle)
    assert len(frames) > 5 and len(index) == 300
    for entry, (key, raw) in list(zip(index, records))[::17]:
        assert entry[0] == key and warc.fetch(bundle, frames, entry) == raw
    # any reader of plain Zstandard streams reads it too: the other frames are skippable
    with zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True) as r:
        assert r.read() == b"".join(raw for _, raw in records)
    assert struct.unpack("<I", bundle[-4:])[0] == 0x8F92EAB1
    with pytest.raises(ValueError):
        warc.read_index(bundle[:-1])


def test_odd(spark, tmp_path):
    big = "<p>" + "y" * 3_000_000
    rows = [(1, "u", None), (2, None, ""), (3, "u\r\nx", "a" * 100), (4, "u", "a" * 100), (0, "u", "a" * 99), (5, "u", "a" * 99), (6, "u", "ü\r\n\r\n" * 40), (7, "u", big), (8, "u", big), (None, "u", "a" * 100), (None, "u", "only" * 50), (None, "u", "only" * 50), (3, "u", "a" * 100)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, payload string, frame int")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(df, str(tmp_path / "w")).collect()), key=repr)
    size = lambda h: len((h or "").encode())
    want = []
    for p, _, h in rows:
        firsts = [q for q, _, g in rows if (g or "") == (h or "") and q is not None]
        again = size(h) >= 100 and firsts and p != min(firsts)
        want.append((p, size(h), "revisit" if again else "response", min(firsts) if again else None))
    assert got == sorted(want, key=repr)
    assert warc.warc_round_trip(df.limit(0), str(tmp_path / "e")).count() == 0


def test_damage_is_seen(spark, tmp_path):
    import glob

    df = spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string")
    warc.write_bundles(warc.classed(df).withColumn("payload_digest", __import__("pyspark").sql.functions.lit("0" * 64)), str(tmp_path / "w"))
    assert glob.glob(str(tmp_path / "w" / "part*"))
    with pytest.raises(Exception, match="damaged"):
        warc.read_bundles(spark, str(tmp_path / "w")).collect()
