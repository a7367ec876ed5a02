"""Removal of passages that repeat, by winnowing (operator 1).

Fingerprints are winnowed over the hashes of words, not of whole lines: passages of over RUN words also stand inside longer lines whose rest differs, where no line
hash finds them. Whole lines that repeat are a special case.

A gram is GRAM words from some word on; a window is the RUN words from some word on. Of the grams inside each window the one with the least hash is selected (the rightmost of equals): copies of a window
select the same gram - the fingerprint is guaranteed. Neighbouring windows that select the same gram make a stretch: the match around that gram, extended both ways as far as the gram is
selected. Only selected grams are counted over the corpus, and only of those that occur twice the positions are joined: of equal stretches the later ones
go at once, and of grams that stand in different stretches the windows are compared one by one. A word goes if, and only if, a window with it stands earlier.

Order is by doc_id, then by a digest of the text, then by word, so first copies stay. Windows are told apart by two 64-bit hashes, of the gram and of all their
words; bytes aren't compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotarium.llm.common import hot_keys, small_batches, spread, steps, written
from quotarium.llm.textnum import _DOWN, _UP, buffers, mix, spans, word_hashes

RUN, GRAM = 50, 20
#: Words whose windows are hashed at once; _UP and _DOWN reach one block and the windows that start in it.
_BLOCK = 1 << 19


_KEY = ["doc", "digest"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns({"doc": F.coalesce("doc_id", F.lit(2**63 - 1)), "digest": F.xxhash64("text")})


def word_windows(h: np.ndarray, run: int = RUN, gram: int = GRAM, block: int = _BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block, of the windows from each word on: first word, place and hash of the selected gram, the window's hash, and sums for hashes of longer runs."""
    for a in range(0, len(h) - run + 1, block):
        part = h[a : a + block + run - 1]
        sums = np.r_[np.uint64(0), np.cumsum(part * _UP[: len(part)])]
        value = mix((sums[gram:] - sums[:-gram]) * _DOWN[: len(part) - gram + 1] + np.uint64(gram))
        best, width, wide = np.arange(len(value)), 1, run - gram + 1
        while width < wide:  # of equals the rightmost
            k = min(width, wide - width)
            left, right = best[:-k], best[k:]
            best = np.where(value[right] <= value[left], right, left)
            width += k
        whole = mix((sums[run:] - sums[:-run]) * _DOWN[: len(part) - run + 1] + np.uint64(run))
        yield a, best, value[best], whole, sums


def stretches(h: np.ndarray, cut: np.ndarray, run: int = RUN, gram: int = GRAM, block: int = _BLOCK) -> tuple[np.ndarray, ...]:
    """Of all runs of windows that select one gram, in texts of the words h[cut[i] : cut[i + 1]]: text, first word among all, number of windows, hashes of gram and stretch."""
    out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2]
    end = np.repeat(cut[1:], np.diff(cut))
    for a, best, value, _, sums in word_windows(h, run, gram, block):
        ok = np.flatnonzero(np.arange(a, a + len(best)) + run <= end[a : a + len(best)])
        if not len(ok):
            continue
        head = np.flatnonzero(np.r_[True, (np.diff(ok) > 1) | (np.diff(best[ok]) != 0)])
        n = np.diff(np.r_[head, len(ok)])
        first = ok[head]
        last = first + n - 1 + run
        out.append((np.searchsorted(cut, first + a, side="right") - 1, first + a, n, value[first], mix((sums[last] - sums[first]) * _DOWN[first] + (last - first).astype(np.uint64))))
    return tuple(np.concatenate(x) for x in zip(*out))


def _words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin."""
    data, offsets = buffers(col)
    starts, ends = spans(data, offsets)
    return word_hashes(data, starts, ends, lower=False), np.searchsorted(starts, offsets)


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without runs [a, z) of its words, and the number of lines that went whole. Lines without words go with a run that encloses them."""
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = spans(data, np.array([0, len(data)]))
    newline = np.flatnonzero(data == 10)
    line = np.searchsorted(newline, starts)
    drop, inside = np.zeros(len(starts) + 1, dtype=bool), np.zeros(len(starts) + 1, dtype=bool)
    for a, z in runs:
        drop[a:z] = True
        inside[a + 1 : z] = True  # between this word and the one before
    drop = drop[:-1]
    n = len(newline) + 1
    total, left = np.bincount(line, minlength=n), np.bincount(line[~drop], minlength=n)
    after = np.searchsorted(line, np.arange(n))  # the first word behind a line without words
    gone = np.where(total > 0, left == 0, inside[after])
    keep = np.ones(len(data), dtype=bool)
    head = np.flatnonzero(drop & np.r_[True, ~drop[:-1] | (line[1:] != line[:-1])])
    tail = np.flatnonzero(drop & np.r_[~drop[1:] | (line[1:] != line[:-1]), True])
    for a, z in zip(head.tolist(), tail.tolist()):
        if left[line[a]]:
            if z + 1 < len(starts) and line[z + 1] == line[z]:
                keep[starts[a] : starts[z + 1]] = False
            else:
                keep[ends[a - 1] : ends[z]] = False
    begin, stop = np.r_[0, newline + 1], np.r_[newline, len(data)]
    return b"\n".join(data[a:z][keep[a:z]].tobytes() for a, z in zip(begin[~gone].tolist(), stop[~gone].tolist())).decode(), int(gone.sum())


def repeated(rows: DataFrame) -> DataFrame:
    """doc, digest, runs [a, z) of the words of each text that stand earlier; rows: as _keyed gives them."""
    lists = lambda cut, names, *values: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(v) for v in values], names))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, cut = _words(b["text"])
            own, first, n, gram, whole = stretches(h, cut)
            # a stretch that stands twice in a text: only its first copy meets other texts
            order = np.lexsort((first, whole, gram, own))
            same = np.r_[False, (own[order][1:] == own[order][:-1]) & (gram[order][1:] == gram[order][:-1]) & (whole[order][1:] == whole[order][:-1])] if len(order) else np.zeros(0, bool)
            again = np.zeros(len(order), dtype=bool)
            again[order] = same
            place, n, docs_ = (first - cut[own]).astype(np.int32), n.astype(np.int32), np.arange(len(b) + 1)
            marks = lists(np.searchsorted(own[~again], docs_), ["gram", "whole", "place", "n"], gram[~again].view(np.int64), whole[~again].view(np.int64), place[~again], n[~again])
            yield pa.RecordBatch.from_arrays([b["doc"], b["digest"], marks, lists(np.searchsorted(own[again], docs_), ["place", "n"], place[again], n[again])], names=[*_KEY, "marks", "hits"])

    scanned = written(rows.select(*_KEY, "text").mapInArrow(scan, "doc long, digest long, marks array<struct<gram: long, whole: long, place: int, n: int>>, hits array<struct<place: int, n: int>>"), "stretches")
    marks = scanned.select(*_KEY, F.explode("marks").alias("m")).select("m.*", *_KEY)
    place = [*_KEY, "place"]
    counted = lambda df, on: written(df.groupBy(*on).agg(F.count("*").alias("c")).filter("c > 1"), "counts")
    again = counted(marks, ["gram"])
    marks = written(spread(marks, again.select("gram"), ["gram"], place, lambda: hot_keys(again, ["gram"], F.col("c")), row_bytes=24), "marks")
    first = written(marks.groupBy("gram", "whole").agg(F.min(F.struct(*_KEY, "place", "n")).alias("a"), F.count("*").alias("c")), "first")

    def later(of: DataFrame, anchors: DataFrame) -> DataFrame:
        """The rows that aren't the first with their window."""
        found = anchors.filter("c > 1")
        return spread(of, found.select("gram", "whole", "a"), ["gram", "whole"], place, lambda: hot_keys(found, ["gram", "whole"], F.col("c"))).filter(F.struct(*place) != F.struct("a.doc", "a.digest", "a.place"))

    hits = later(marks, first).select(*_KEY, "place", "n")
    mixed = counted(first.select("gram"), ["gram"])
    todo = spread(first.drop("c"), mixed.select("gram"), ["gram"], ["whole"], lambda: hot_keys(mixed, ["gram"], F.col("c")), row_bytes=24)
    todo = todo.select("a.*").groupBy(*_KEY).agg(F.collect_list(F.struct("place", "n")).alias("want"))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, cut = _words(b["text"])
            want = np.zeros(len(h) + 1, dtype=np.int64)
            for c, w in zip(cut.tolist(), b["want"]):
                place, n = (w.values.field(k).to_numpy() for k in (0, 1))
                np.add.at(want, c + place, 1)
                np.add.at(want, c + place + n, -1)
            want = np.cumsum(want) > 0
            for a, _, value, whole, _ in word_windows(h):
                at = np.flatnonzero(want[a : a + len(whole)])
                own = np.searchsorted(cut, at + a, side="right") - 1
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays([b["doc"].take(take), b["digest"].take(take), pa.array(value[at].view(np.int64)), pa.array(whole[at].view(np.int64)), pa.array((at + a - cut[own]).astype(np.int32))], names=[*_KEY, "gram", "whole", "place"])

    windows = written(rows.select(*_KEY, "text").join(_small(written(todo, "todo"), "want"), _KEY).mapInArrow(single, "doc long, digest long, gram long, whole long, place int"), "windows")
    anchors = written(windows.groupBy("gram", "whole").agg(F.min(F.struct(*place)).alias("a"), F.count("*").alias("c")).filter("c > 1"), "anchors")
    hits = hits.unionByName(later(windows, anchors).select(*_KEY, "place", F.lit(1).alias("n"))).unionByName(scanned.select(*_KEY, F.explode("hits").alias("h")).select(*_KEY, "h.*"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = []
            for x in b["hits"]:
                place, n = (x.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                order = np.argsort(place, kind="stable")
                a, z = place[order], np.maximum.accumulate((place + n - 1 + RUN)[order])
                head = np.flatnonzero(np.r_[True, a[1:] >= z[:-1]])
                runs.append([{"a": int(p), "z": int(q)} for p, q in zip(a[head], z[np.r_[head[1:], len(a)] - 1])])
            yield pa.RecordBatch.from_arrays([b["doc"], b["digest"], pa.array(runs, pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())])))], names=[*_KEY, "runs"])

    return hits.groupBy(*_KEY).agg(F.collect_set(F.struct("place", "n")).alias("hits")).mapInArrow(merge, "doc long, digest long, runs array<struct<a: int, z: int>>")


def passage_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text (what is left), n_lines, n_removed_lines (those that went whole) of every row.

    Deletes each word in a run of RUN words, across lines or inside one, that stands earlier in the order. Null counts as empty; an empty text has no lines. Rows of one doc_id and
    text are one document. A null doc_id comes last in the order. Texts of any length are read whole, in blocks. An empty table gives no rows; only doc_id and text are read, so other
    columns can't clash. A passage that very many documents share is dealt over tasks.
    """
    small_batches(docs.sparkSession)
    rows = _keyed(docs)
    with steps(docs.sparkSession) as keep:
        cuts = keep(written(repeated(rows), "cuts"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, n, gone = [], [], []
            for t, runs in zip(b["text"].to_pylist(), b["runs"].to_pylist()):
                left, k = without(t, [(r["a"], r["z"]) for r in runs]) if runs else (t, 0)
                text.append(left), n.append(t.count("\n") + 1 if t else 0), gone.append(k)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "text", "n_lines", "n_removed_lines"])

    return rows.join(_small(cuts, "runs"), _KEY, "left").select("doc_id", "text", "runs").mapInArrow(remove, "doc_id long, text string, n_lines long, n_removed_lines long")


def _small(df: DataFrame, items: str, limit: int = 24 << 20) -> DataFrame:
    """bounded() for rows with a list: by the lengths of all lists."""
    return F.broadcast(df) if (df.agg(F.sum(64 + 16 * F.size(items))).first()[0] or 0) <= limit else df
