"""Best-fit packing of documents into sequences: best-two-fit (operator 5).

Documents longer than a sequence are cut; every other piece keeps whole. Packing only needs to know how many pieces
have each length, a table of at most `capacity` rows, so that table alone goes to the driver. There a bin is
filled greedily (largest remaining length that fits, again and again); then its smallest piece is replaced by two
unpacked pieces if their sum fits the gap that leaves more tightly. A swap can spend small pieces that later bins need, so the same counts are also packed
without swaps, and the packing of fewer bins is taken. A filled bin is a pattern of lengths; it's used as often
as the counts allow, so there are a few thousand patterns for any number of pieces. Pieces are numbered within their length in
parallel and find their bin by their number.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotarium.llm.bpe import encoder
from quotarium.llm.common import small_batches, written


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins), in the order filled; the greedy bins where swaps don't save any but cost some."""
    return min(filled(counts, capacity), filled(counts, capacity, swap=False), key=lambda bins: sum(times for _, times in bins))


def filled(counts: dict[int, int], capacity: int, swap: bool = True) -> list[tuple[list[int], int]]:
    """One pass over the counts, with or without the replacement of a bin's smallest piece by two."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    out = []
    # fits[i]: largest length <= i that remains; lengths that run out point to the next smaller one
    fits = np.arange(capacity + 1)

    def largest(n: int) -> int:
        root = n
        while root > 0 and not left[root]:
            fits[root] = fits[root] - 1 if fits[root] == root else fits[root]
            root = fits[root]
        while n > root:
            n, fits[n] = fits[n], root
        return int(root)

    while top := largest(capacity):
        bin_, gap, used = [], capacity, Counter()
        n = top
        while n:
            k = int(min(gap // n, left[n] - used[n]))
            if k <= 0:
                n = largest(n - 1) if n > 1 else 0
                continue
            bin_ += [n] * k
            used[n] += k
            gap -= n * k
            n = largest(min(gap, n - 1)) if gap else 0
        if swap and gap and len(bin_) > 1:
            small = bin_[-1]
            room = gap + small
            has = left[: room + 1].copy()
            for n, k in used.items():
                if n <= room:
                    has[n] -= k
            have = np.flatnonzero(has > 0)
            have = have[have > 0]
            best, pair = small, None
            # for each first length the largest second that fits
            if len(have):
                at = np.searchsorted(have, room - have, side="right") - 1
                ok = at >= 0
                a, b = have[ok], have[at[ok]]
                same = (a == b) & (has[a] < 2)
                step = at[ok] - same
                ok2 = step >= 0
                a, b = a[ok2], have[step[ok2]]
                if len(a) and (i := int(np.argmax(a + b))) is not None and a[i] + b[i] > best and not (a[i] == b[i] and has[a[i]] < 2):
                    pair = (int(max(a[i], b[i])), int(min(a[i], b[i])))
            if pair:
                used[small] -= 1
                bin_[-1:] = pair
                used.update(pair)
        times = int(min(left[n] // k for n, k in used.items() if k))
        for n, k in used.items():
            left[n] -= k * times
        out.append((sorted(bin_, reverse=True), times))
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each document."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4")
        for b in batches:
            doc, piece, start, length, crc, own = [], [], [], [], [], []
            for d, ids in zip(b["doc_id"].to_pylist(), enc.encode(b["text"])):
                ids = np.concatenate([ids, end])
                for k, i in enumerate(range(0, len(ids), capacity)):
                    part = ids[i : i + capacity].tobytes()
                    doc.append(d), piece.append(k), start.append(i), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if keep_ids:
                        own.append(part)
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(own, pa.binary())] * keep_ids, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(cut, schema)


#: Bytes of runs that may be sent to every task.
RUNS_BYTES = 64 << 20
_RUN = "struct<first: long, per_bin: long, seq: long, place: long>"


def _chunked(runs: list[tuple]) -> list[tuple]:
    """(length, first numbers of its chunks, chunks of its runs); runs: (length, first, rows, per_bin, seq, place)."""
    of: dict[int, list[tuple]] = {}
    for n, first, _, per_bin, seq, place in runs:
        of.setdefault(n, []).append((first, per_bin, seq, place))
    out = []
    for n, own in of.items():
        own.sort()
        step = math.isqrt(len(own) - 1) + 1
        out.append((n, [own[i][0] for i in range(0, len(own), step)], [own[i : i + step] for i in range(0, len(own), step)]))
    return out


def assign(parts: DataFrame, capacity: int, bucket_rows: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces (at least doc_id, piece, length)."""
    spark = parts.sparkSession
    buckets = max(16, parts.count() // bucket_rows)
    # a piece's bucket hangs on its identity alone: a task that runs again numbers alike
    rows = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    per = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    per = written(per, "pack-counts")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = []
    seq, taken = 0, Counter()
    for bin_, times in best_two_fit(counts, capacity):
        place = 0
        for n, k in Counter(bin_).items():
            # the k pieces of this length in bin j of the run are numbers first + j * k ...
            runs.append((n, taken[n], k * times, k, seq, place))
            taken[n] += k * times
            place += n * k
        seq += times
    # runs of a length in chunks, by their first number: a piece searches the chunks, then one chunk. There are at most a few runs for each length and pattern
    table = spark.createDataFrame(_chunked(runs), f"length long, heads array<long>, chunks array<array<{_RUN}>>")
    lists = F.broadcast(table) if 48 * len(runs) <= RUNS_BYTES else table
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = per.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece")
    numbered = rows.withColumn("number", F.row_number().over(inside) - 1).join(shift, ["bucket", "length"]).withColumn("number", F.col("number") + F.col("shift"))
    chunk = F.element_at("chunks", F.size(F.filter("heads", lambda h: h <= F.col("number"))))
    out = numbered.join(lists, "length").withColumn("run", F.element_at(F.filter(chunk, lambda r: r["first"] <= F.col("number")), -1)).withColumn("k", F.col("number") - F.col("run.first"))
    out = out.withColumns({"sequence_id": F.col("run.seq") + F.floor(F.col("k") / F.col("run.per_bin")), "offset": F.col("run.place") + (F.col("k") % F.col("run.per_bin")) * F.col("length")})
    return out.select(*parts.columns, F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Packs all documents (null text: empty) into sequences of at most `capacity` tokens.

    Returns one row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids). An empty text is the end id alone. Rows that
    repeat a doc_id are packed like any other (equal pieces may swap places); a null doc_id is packed too. An empty table gives no rows.
    """
    return assign(written(pieces(docs, tokenizer, capacity, end_id, keep_ids), "pack-pieces"), capacity)
