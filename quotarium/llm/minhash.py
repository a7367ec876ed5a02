"""Near duplicates by circulant MinHash (operator 6).

All coordinates of a signature come from two permutations: the first scatters the shingles over a ring of 2^32 places, the
second is applied after shifting the ring by the coordinate's number. Coordinates are banded; texts that share a band are candidates, and candidates
are confirmed on their full shingle sets.

Texts with equal sets are one class, found by digest, and only class representatives are banded. In a bucket nobody is paired with
everybody: all members are compared with one pivot, the member that shares most buckets. For members r and x that aren't both
linked with the pivot, and any reference set p, |r & x| <= min(|r & p|, |x & p|) + |(r - p) & (x - p)|: they can be linked only if they share a shingle outside p,
or if p covers enough of both. With the pivot's family's consensus as p, few do. So members are dealt again by their shingles outside it (of which a prefix in hash order is enough), and
those that it covers by their size. Where that still makes many pairs, such parts get pivots in turn; else their pairs are compared. No link between candidates is lost.
Links, components and sets stay distributed.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotarium.llm.common import bounded, hot_keys, small_batches, spread, steps, written
from quotarium.llm.textnum import mix, shingle_sets

BANDS, ROWS = 25, 5


def signature(sets: list[np.ndarray], coordinates: int = BANDS * ROWS, block: int = 1 << 14) -> np.ndarray:
    """Circulant MinHash of non-empty sets: (len(sets), coordinates) of uint32."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full((len(sets), coordinates), np.uint32(2**32 - 1))
    i = 0
    while i < len(sets):
        j = max(i + 1, int(np.searchsorted(np.cumsum(sizes[i:]), block, side="right")) + i)
        flat = np.concatenate(sets[i:j])
        at = np.r_[0, np.cumsum(sizes[i:j])[:-1]]
        for a in range(0, len(flat), 4 * block):  # only a set larger than a block is cut
            part = (mix(flat[a : a + 4 * block] ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
            begin = at if j > i + 1 or len(flat) <= 4 * block else np.zeros(1, np.int64)
            for k in range(coordinates):
                y = part + np.uint32(k)
                y ^= y >> np.uint32(16)
                y *= np.uint32(0x85EBCA6B)
                y ^= y >> np.uint32(13)
                y *= np.uint32(0xC2B2AE35)
                y ^= y >> np.uint32(16)
                out[i:j, k] = np.minimum(out[i:j, k], np.minimum.reduceat(y, begin))
        i = j
    return out


def bands(sig: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """64-bit key of each band; bands differ in their keys."""
    rows = sig.shape[1] // n_bands
    key = np.zeros((len(sig), n_bands), dtype=np.uint64) + np.arange(n_bands, dtype=np.uint64)
    for r in range(rows):
        key = mix(key + sig[:, r::rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return key


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, words: int, lower: bool) -> DataFrame:
    """doc_id, n_shingles, set_digest (null for an empty set), bands."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b["text"], words, lower)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = bands(signature([sets[i] for i in full])).astype(np.int64) if full else None
            digest, band = [None] * len(sets), [None] * len(sets)
            for r, i in enumerate(full):
                digest[i], band[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), keys[r]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_digest", "bands"])

    return _text(docs).mapInArrow(run, "doc_id long, n_shingles long, set_digest binary, bands array<long>")


def shingles(docs: DataFrame, words: int, lower: bool) -> DataFrame:
    """id, shingles (sorted distinct hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.view(np.int64) for s in shingle_sets(b["text"], words, lower)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return _text(docs).mapInArrow(run, "id long, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of a table of links a, b. Labels spread along links and jump to their label's label. Nodes that are few enough are broadcast, else links of hubs and members of large components are dealt over tasks."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    nodes = label.count()
    small = F.broadcast if nodes * 32 <= 24 << 20 else (lambda df: df)
    hubs = functools.cache(lambda: hot_keys(both, ["b"]))
    while True:
        near = spread(both, label.select(F.col("id").alias("b"), F.col("component").alias("c")), ["b"], ["a"], hubs, row_bytes=32).groupBy("a").agg(F.min("c").alias("c"))
        step = near.join(small(label), F.col("id") == F.col("a")).select("id", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        step = written(step, "labels")
        up = step.select(F.col("id").alias("component"), F.col("component").alias("up"))
        new = written(spread(step, up, ["component"], ["id"], lambda step=step: hot_keys(step, ["component"]), "left", 32).select("id", "was", F.least("component", "up").alias("component")), "labels")
        if new.filter("was <> component").isEmpty():
            return new.select("id", "component")
        label = new.select("id", "component")


def _joined(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """Written pairs with both sets' sizes and the sets: na, nb, sa, sb. Pairs of an `a` that has very many are dealt over tasks."""
    left = pairs.join(sets.withColumnsRenamed({"id": b, "shingles": "sb"}), b)
    left = spread(left, sets.withColumnsRenamed({"id": a, "shingles": "sa"}), [a], [b], lambda: hot_keys(pairs, [a]))
    return left.withColumns({"na": F.size("sa"), "nb": F.size("sb")})


def _against_pivot(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Written pairs (family, pivot, id, pivot_label, label): family, pivot, id, linked and the new label, which is the pivot's where they are linked."""
    rows = _joined(pairs, sets, "pivot", "id").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    linked = 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))
    return rows.withColumn("linked", linked).select("family", "pivot", "id", F.when(F.col("linked"), F.col("pivot_label")).otherwise(F.col("label")).alias("label"), "linked")


#: Families from this size on get a consensus, of about so many members.
CONSENSUS_FROM, CONSENSUS_OF = 8, 64


def _references(families: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """family, ref: a set that most of a family's sets are near to. Any set would do, so the shingles of more than half of a hashed sample of members serve; small families use their pivot."""
    large = families.filter(F.col("size") >= CONSENSUS_FROM).select("family", "size")
    some = rows.join(large, "family").filter(F.pmod(F.xxhash64("id", F.lit("reference")), F.ceil(F.col("size") / CONSENSUS_OF)) == 0).select("family", "id").distinct()
    some = written(some, "sampled")
    counts = some.groupBy("family").agg(F.count("*").alias("k"))
    common = some.join(sets, "id").select("family", F.explode("shingles").alias("x")).groupBy("family", "x").agg(F.count("*").alias("c")).join(counts, "family").filter(2 * F.col("c") > F.col("k"))
    consensus = common.groupBy("family").agg(F.collect_list("x").alias("consensus"))
    own = families.select("family", F.col("pivot").alias("id")).join(sets.dropDuplicates(["id"]), "id")
    return own.join(consensus, "family", "left").select("family", F.coalesce("consensus", "shingles").alias("ref"))


def _bounded_sets(refs: DataFrame, column: str, limit: int = 24 << 20) -> DataFrame:
    """Marks a written table of sets for broadcast only if their counted bytes fit a limit."""
    size = refs.agg(F.sum(F.size(column) * 8 + 48)).first()[0] or 0
    return F.broadcast(refs) if size <= limit else refs


def _described(rows: DataFrame, refs: DataFrame, sets: DataFrame, percent: int, hot: Callable[[], DataFrame | None]) -> DataFrame:
    """family, id, label, n, cover (shingles in the reference), near (similarity to it) and outside: the first shingles outside the reference, as many as are needed."""
    all_ = spread(rows.select("family", "id", "label").join(sets, "id"), refs, ["family"], ["id"], hot).withColumns({"n": F.size("shingles"), "cover": F.size(F.array_intersect("shingles", "ref"))})
    # a partner has at least percent of this set, so it shares at least so many shingles that lie outside the reference
    least = F.ceil(F.col("n") * percent / 100 - F.lit(1e-9)) - F.col("cover")
    outside = F.slice(F.array_except("shingles", "ref"), 1, F.greatest(F.col("n") - F.col("cover") - F.greatest(least, F.lit(1)) + 1, F.lit(0)).cast("int"))
    return all_.select("family", "id", "label", "n", "cover", (F.col("cover") / (F.col("n") + F.size("ref") - F.col("cover"))).alias("near"), outside.alias("outside"))


_PART = ["family", "part", "kind"]


def _parts(rows: DataFrame, percent: int) -> DataFrame:
    """family, part, kind, id, label, n, cover of what may still be linked: one row for each shingle outside the reference, and for sizes where the reference covers enough of a set."""
    by_shingle = rows.select("family", F.explode("outside").alias("part"), "id", "label", "n", "cover", "near")
    covered = rows.filter(100 * F.col("cover") >= percent * F.col("n"))
    # linked sizes differ by a factor of 100 / percent at most: equal or neighbouring places
    place = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / min(percent, 99))) + F.lit(1e-9)).cast("long")
    at = F.explode(F.array(place, place + 1)).alias("part")
    by_size = covered.select("family", at, "id", "label", "n", "cover", "near").withColumn("part", F.xxhash64(F.lit("size"), "part"))
    # only sets small enough to be linked through the reference alone
    parts = dealt = written(by_shingle.withColumn("kind", F.lit(0)).unionByName(by_size.withColumn("kind", F.lit(1))), "dealt")
    room = parts.groupBy(*_PART).agg(F.min("n").alias("smallest"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").drop("lo", "hi")
    parts = spread(parts, room, _PART, ["id"], lambda: hot_keys(dealt, _PART), row_bytes=48)
    parts = written(parts.filter((F.col("kind") == 0) | ((100 + percent) * F.col("cover") >= percent * (F.col("n") + F.col("smallest")))).drop("smallest"), "dealt")
    open_ = parts.groupBy(*_PART).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select(*_PART)
    return spread(parts, open_, _PART, ["id"], lambda: hot_keys(dealt, _PART), row_bytes=48)


def _may_link(percent: int) -> Column:
    """Whether sizes and covers of two members of a part leave room for a link."""
    least = F.least("cover", "cover2")
    shared = F.when(F.col("kind") == 0, least + F.least(F.col("n") - F.col("cover"), F.col("n2") - F.col("cover2"))).otherwise(least)
    return (100 + percent) * shared >= percent * (F.col("n") + F.col("n2"))


def _remaining_pairs(parts: DataFrame, percent: int) -> DataFrame:
    other = parts.select(*_PART, F.col("id").alias("id2"), F.col("label").alias("label2"), F.col("n").alias("n2"), F.col("cover").alias("cover2"))
    both = spread(parts, other, _PART, ["id"], lambda: hot_keys(parts, _PART)).filter((F.col("id") < F.col("id2")) & (F.col("label") != F.col("label2")) & _may_link(percent))
    return both.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()


def _pivots(parts: DataFrame) -> DataFrame:
    """family (new), pivot, id, pivot_label, label: each part's member that is nearest to the reference is the pivot of that part."""
    best = parts.groupBy(*_PART).agg(F.max_by(F.struct("id", "label"), F.struct("near", "id")).alias("p"))
    out = spread(parts, best, _PART, ["id"], lambda: hot_keys(parts, _PART)).filter(F.col("id") != F.col("p.id"))
    return out.select(F.xxhash64("family", "p.id").alias("family"), F.col("p.id").alias("pivot"), "id", F.col("p.label").alias("pivot_label"), "label").distinct()


#: Pairs for each text that are few enough to be compared one by one. Else parts get pivots in turn, for as long as each round leaves at most this share of the pairs (in
#: a hundred) of the one before; what no reference set tells apart must be compared in any case.
PAIRS, LEAST_PAIRS, LEFT = 16, 20_000, 80


def candidate_links(members: DataFrame, docs: DataFrame, words: int, percent: int, lower: bool, texts: int, full: Callable[[], DataFrame | None]) -> DataFrame:
    """a, b of linked class representatives. members: written (key, id, m) of the buckets with m > 1 members; texts: number of classes; full: buckets of very many members."""
    score = members.groupBy("id").agg((F.sum("m") * 1048576 + F.max(F.pmod(F.xxhash64("id"), F.lit(1048576)))).alias("score"))
    members = written(members.join(score, "id"), "scored")
    pivot = members.groupBy("key").agg(F.max_by("id", "score").alias("pivot"))
    first = spread(members, pivot, ["key"], ["id"], full).filter("id <> pivot").select("pivot", "id").distinct()
    todo = written(first.select(F.col("pivot").alias("family"), "pivot", "id", F.col("pivot").alias("pivot_label"), F.col("id").alias("label")), "pairs")
    ids = bounded(written(todo.select("pivot").union(todo.select("id")).toDF("id").distinct(), "wanted"), 24)
    # rows that repeat a doc_id with different texts: any of them may link
    sets = written(shingles(docs.join(ids, docs["doc_id"].cast("long") == ids["id"], "left_semi"), words, lower), "sets")
    links, before = None, None
    while True:
        compared = written(_against_pivot(todo, sets, percent), "compared")
        found = compared.filter("linked").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
        links = found if links is None else links.unionByName(found)
        open_ = compared.groupBy("family", "pivot").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).filter("lo < hi")
        families = written(open_.select("family", "pivot", "size"), "families")
        hot = functools.cache(lambda families=families: hot_keys(families, ["family"], F.col("size")))
        rows = spread(compared, families.select("family"), ["family"], ["id"], hot, row_bytes=48)
        refs = _bounded_sets(written(_references(families, rows, sets), "references"), "ref")
        described = written(_described(rows, refs, sets, percent, hot), "described")
        # the pivot is only the likeliest centre; the member that is nearest to the consensus is a better one
        nearest = described.groupBy("family").agg(F.max_by(F.struct(F.col("id").alias("pivot"), F.col("label").alias("pivot_label")), F.struct("near", "id")).alias("q"), F.count("*").alias("size"))
        nearest = written(nearest.filter(F.col("size") >= CONSENSUS_FROM).select("family", "q.*"), "nearest")
        again = written(spread(described.select("family", "id", "label"), nearest, ["family"], ["id"], hot, row_bytes=48).filter(F.col("id") != F.col("pivot")), "again")
        again = written(_against_pivot(again, sets, percent), "compared")
        links = links.unionByName(again.filter("linked").select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        met = described.join(again.select("family", "id", F.col("label").alias("new"), F.col("pivot").alias("q")), ["family", "id"], "left").withColumn("label", F.coalesce("new", "label")).drop("new", "q")
        parts = written(_parts(met, percent), "parts")
        each = parts.groupBy("family", "part", "kind", "label").agg(F.count("*").alias("n")).groupBy("family", "part", "kind").agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("n"))
        total = (each.agg(F.sum("n")).first()[0] or 0) // 2
        if not total:
            return links
        if total <= max(LEAST_PAIRS, PAIRS * texts) or (before and 100 * total > LEFT * before):
            break
        before = total
        todo = written(_pivots(parts), "pairs")
    pairs = written(_remaining_pairs(parts, percent), "pairs")
    sized = _joined(pairs, sets, "a", "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).withColumn("both", F.size(F.array_intersect("sa", "sb")))
    found = sized.filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")
    return links.unionByName(found)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Texts are linked if 100 * intersection >= percent * union of their shingle sets. component_id is the smallest doc_id reachable; kept marks it. Null and
    empty texts, and texts without words, have no set and stay alone. Rows that repeat a doc_id
    with different texts are judged by their own sets, or by those of any of them; a null doc_id is linked by equal sets only. Texts of any length count whole. An empty table gives no rows; only
    doc_id and text are read, so other columns can't clash.
    """
    sig = written(signatures(docs, words, lower), "signatures")
    full, empty = sig.filter("set_digest is not null"), sig.filter("set_digest is null")
    with steps(docs.sparkSession) as keep:
        classes = written(full.groupBy("set_digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")).filter("id is not null"), "classes")
        rep = sig.join(classes, (sig["doc_id"] == classes["id"]) & (sig["set_digest"] == classes["set_digest"])).select("id", F.explode(F.array_distinct("bands")).alias("key")).distinct()
        rep = written(rep, "banded")
        shared = written(rep.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "shared")
        large = functools.cache(lambda: hot_keys(shared, ["key"], F.col("m")))
        members = written(spread(rep, shared, ["key"], ["id"], large, row_bytes=32), "members")
        label = components(candidate_links(members, docs, words, percent, lower, classes.count(), large))
        named = keep(written(classes.join(label, "id", "left").select("set_digest", "copies", F.coalesce("component", "id").alias("component")), "named"))
    often = lambda: hot_keys(named, ["set_digest"], F.col("copies"))
    out = spread(full.select("doc_id", "n_shingles", "set_digest"), named.drop("copies"), ["set_digest"], ["doc_id"], often, "left", 72).select("doc_id", "n_shingles", "component")
    out = out.unionByName(empty.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component")))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
