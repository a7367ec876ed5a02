"""Offset-preserving sentencepiece encoding and decoding (operator 10).

The text is normalised here, by the longest prefixes of the model's compiled character map, and every normalised byte keeps the span of
source bytes it came from (charsmap.py). The library gives the ids; since pieces tile the normalised text, each is projected
to its span of original bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotarium.llm.charsmap import USER_DEFINED, Normalizer, piece_lengths, project, read_model
from quotarium.llm.common import small_batches


class OffsetEncoder:
    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        m = read_model(path)
        self.norm = Normalizer(m.charsmap, m.dummy_prefix, m.trims, m.escapes, [p for p, k in zip(m.pieces, m.kinds) if k == USER_DEFINED])
        self.lengths, self.pieces = piece_lengths(m), m.pieces

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Byte span in the text of each id; begin, end and pieces of the dummy prefix alone have empty spans."""
        new, start, end = self.norm.align(text.encode("utf-8", "replace"))
        return project(np.asarray(ids, dtype=np.int64), self.lengths, start, end, self.pieces, bytes(new))


@functools.cache
def offset_encoder(path: str) -> OffsetEncoder:
    return OffsetEncoder(path)


def encode_with_offsets(docs: DataFrame, model: str, full: bool = True) -> DataFrame:
    """Ids with begin and end ids, byte spans and the decoded text of every document (null text: empty, which is the begin and end ids alone).

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, spans_tile (the spans follow one another and cover all bytes) and, with full, ids,
    span_start, span_end and decoded. Several bytes of one character share its span; an unknown piece spans what its neighbours leave. Repeated rows and null doc_ids are encoded like any other, texts of any
    length whole; an empty table gives no rows. Only doc_id and text are read, so other columns can't clash.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_tile boolean" + ", ids array<int>, span_start array<long>, span_end array<long>, decoded string" * full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = offset_encoder(model)
        for b in batches:
            texts = b["text"].to_pylist()
            ids = enc.lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            back = enc.lib.decode(ids, num_threads=1) if ids else []
            tile, starts, ends = [], [], []
            for t, x in zip(texts, ids):
                a, z = enc.spans(t, x)
                # bytes of one character may be pieces of their own: then they share the character's span
                tile.append(bool((a[1:] >= a[:-1]).all() and (z[1:] >= z[:-1]).all() and (a[1:] <= z[:-1]).all()) and (z[-1] if len(z) else 0) == len(t.encode("utf-8", "replace")))
                starts.append(a), ends.append(z)
            cols = [b["doc_id"], pa.array(map(len, ids), pa.int64()), pa.array([hashlib.sha256(np.array(x, dtype="<u4").tobytes()).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()), pa.array(tile, pa.bool_())]
            if full:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_tile", "ids", "span_start", "span_end", "decoded"][: len(cols)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)
