import hashlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotarium.llm import charsmap, pieces, queries, token_counts
from quotarium.llm.bpe import encoder

MODEL, WORDS = queries.tokenizer("piece_bpe_32k.model"), queries.tokenizer("word_bpe_49k.json")
TOK = Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts(spark, sf_dir, docs, lib):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    for r in queries.op8_token_counts(spark, sf_dir).collect():
        n = len(lib.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def test_count_odd(odd, none, lib):
    rows = sorted(((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(odd, MODEL).collect()), key=repr)
    assert rows == sorted(((r["doc_id"], len(lib.encode(r["text"] or ""))) for r in odd.collect()), key=repr)
    assert token_counts.count_tokens(none, MODEL).count() == 0


def test_cache(spark, tmp_path):
    """Known contents aren't encoded again, and another tokenizer has counts of its own."""
    cache = str(tmp_path / "cache")
    rows = spark.createDataFrame([(1, "one text"), (2, "one text"), (3, "another")], "doc_id long, text string")
    first = sorted(map(tuple, token_counts.count_tokens(rows, MODEL, cache).collect()))
    assert spark.read.option("recursiveFileLookup", "true").parquet(cache).count() == 2
    more = rows.union(spark.createDataFrame([(4, "third"), (5, None)], rows.schema))
    assert sorted(map(tuple, token_counts.count_tokens(more, MODEL, cache).filter("doc_id < 4").collect())) == first
    assert spark.read.option("recursiveFileLookup", "true").parquet(cache).count() == 4
    token_counts.count_tokens(rows, WORDS, cache).collect()
    assert spark.read.option("recursiveFileLookup", "true").parquet(cache).select(F.regexp_extract("_metadata.file_path", "tokenizer=([0-9a-f]+)", 1)).distinct().count() == 2


def test_each_content_is_encoded_once(spark, tmp_path):
    """Whatever the ids of its rows: null, repeated, or both."""
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (None, "c"), (None, "c"), (4, "d"), (4, "e"), (5, None), (6, "")]
    docs, cache = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path / "cache")
    got = token_counts.count_tokens(docs, MODEL, cache)
    assert got.count() == len(rows)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == 5


def test_a_frequent_content_is_dealt_over_tasks(spark, monkeypatch, lib):
    monkeypatch.setattr("quotarium.llm.common.HOT_ROWS", 5)
    monkeypatch.setattr("quotarium.llm.common.fits", lambda *a: False)
    rows = [(i, "one text" if i % 3 else f"own {i}") for i in range(90)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), MODEL).collect()}
    assert got == {i: len(lib.encode(t)) for i, t in rows}


def test_query_meets_a_filled_cache(spark, docs, tmp_path, monkeypatch):
    """The same table again: the join to stored counts gives all of them, and nothing is encoded."""
    cache = str(tmp_path / "cache")
    first = sorted((tuple(r) for r in token_counts.count_tokens(docs, MODEL, cache).collect()), key=repr)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(cache).count()
    again = sorted((tuple(r) for r in token_counts.count_tokens(docs, MODEL, cache).collect()), key=repr)
    assert first == again and spark.read.option("recursiveFileLookup", "true").parquet(cache).count() == stored


TEXTS = st.text(st.one_of(st.characters(blacklist_categories=["Cs"]), st.sampled_from("ab '\n\t éß ﬁ½Ⅷ's9<|endoftext|>")), max_size=60)


@given(st.lists(TEXTS, min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_word_ids_are_the_librarys(texts):
    assert [x.tolist() for x in encoder(WORDS).encode(pa.array(texts, pa.string()))] == [TOK.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_ids_of_odd_texts():
    texts = ["<|endoftext|> and <|startoftext|>x", "DON'T I'LL", "a" * 500, "ÀÉÎ İı ſ", "x\x85y　z", "1234 ½ ²", "'s'S 'Re", "é", "\x00\x1f", "", " " * 99, "'", "''s", "x.'s", "we've'd'lls", "'re", "'r", "e", "a'", "s", "² ¼a×b÷cª1µ", "12'34'ves"]
    assert [x.tolist() for x in encoder(WORDS).encode(pa.array(texts, pa.string()))] == [TOK.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces(spark, sf_dir, docs, lib):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    for r in queries.op10_sentencepiece(spark, sf_dir).collect():
        ids = lib.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest() and r["spans_tile"]


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_normalisation_and_spans(text):
    """Our normal form is the library's; spans follow one another and cover the text's bytes; its own offsets, where it gives them, are ours."""
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    enc = pieces.offset_encoder(MODEL)
    raw = text.encode("utf-8", "replace")
    normal, start, end = enc.norm.align(raw)
    assert len(start) == len(end) == len(bytes(normal))
    ids = lib.encode(text, add_bos=True, add_eos=True)
    a, z = enc.spans(text, ids)
    assert (a[1:] >= a[:-1]).all() and (z <= len(raw)).all() and z[-1] == len(raw)
    inner = "".join(lib.id_to_piece(i) for i in ids[1:-1])
    if "<0x" not in inner:
        assert inner.encode() == bytes(normal)


def test_offsets_by_the_library(lib):
    enc = pieces.offset_encoder(MODEL)
    for text in ("Hello  world", "héllo ﬁne", "  two\tthree ", "Zoë’s ½ cup"):
        proto = lib.encode(text, out_type="immutable_proto") if hasattr(lib, "encode_as_immutable_proto") else None
        ids = lib.encode(text)
        a, z = enc.spans(text, ids)
        if proto is not None:
            chars = [(p.begin, p.end) for p in proto.pieces]
            to_bytes = [0]
            for c in text:
                to_bytes.append(to_bytes[-1] + len(c.encode()))
            assert [(to_bytes[x], to_bytes[y]) for x, y in chars] == list(zip(a.tolist(), z.tolist()))


def test_piece_odd(odd, none, lib):
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in pieces.encode_with_offsets(odd, MODEL).collect()), key=repr)
    want = []
    for r in odd.collect():
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        want.append((r["doc_id"], len(ids), ids, lib.decode(ids)))
    assert got == sorted(want, key=repr)
    assert pieces.encode_with_offsets(none, MODEL).count() == 0
    assert isinstance(charsmap.read_model(MODEL).is_bpe, bool)


def bytes_at(text):
    out = [0]
    for c in text:
        out.append(out[-1] + len(c.encode()))
    return out


ODD_TEXTS = st.text(st.one_of(st.characters(blacklist_categories=["Cs"]), st.sampled_from(list(" \u3000\u00a0\tﬁ½Ⅷｶﾞé\u0301한글①㌔ＡＢ") + ["x"])), max_size=40)


@pytest.mark.parametrize("prefix, escape, trim", [(True, True, True), (True, True, False), (False, True, True), (False, False, True), (True, False, False)])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc"])
def test_longest_prefixes_of_a_compiled_map(rule, prefix, escape, trim):
    """Normal form and offsets are those of the library's own normaliser, with real compiled maps."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=escape, remove_extra_whitespaces=trim)
    spec = dict(charsmap._fields(lib.serialized_normalizer_spec()))
    own = charsmap.Normalizer(spec[2], prefix, trim, escape)
    assert own.units

    @given(ODD_TEXTS)
    @settings(max_examples=80, deadline=None)
    def check(text):
        want, offsets = lib.normalize(text, with_offsets=True)
        new, start, end = own.align(text.encode())
        assert new.decode() == want and len(start) == len(end) == len(new)
        at, source = bytes_at(want), bytes_at(text)
        assert [int(start[x]) for x in at[:-1]] == [source[x] for x in offsets[:-1]]
        assert (end >= start).all() and (start[1:] >= start[:-1]).all()

    check()
    text = "ﬁne ½ " * 20_000
    assert own.align(text.encode())[0].decode() == lib.normalize(text)


def test_defined_pieces_stay():
    own = charsmap.Normalizer(dict(charsmap._fields(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec()))[2], False, False, True, ["½", "½ﬁ", "Ⅷx"])
    new, start, end = own.align("½ﬁ½Ⅷ ﬁ".encode())
    assert new.decode() == "½ﬁ½VIII▁fi" and start.tolist()[:5] == [0] * 5 and end.tolist()[:5] == [5] * 5


def test_several_unknown_pieces():
    """ids 0: unknown; the others are literal. Between two known pieces an unknown one takes all."""
    pieces_, lengths = ["<unk>", "ab", "c", "<s>"], np.array([-1, 2, 1, 0])
    new = b"zzabyycxab"
    at = np.arange(len(new))
    a, z = charsmap.project(np.array([3, 0, 1, 0, 2, 0, 1]), lengths, at, at + 1, pieces_, new)
    assert list(zip(a.tolist(), z.tolist())) == [(0, 0), (0, 2), (2, 4), (4, 6), (6, 7), (7, 8), (8, 10)]
    a, z = charsmap.project(np.array([1, 0]), lengths, at[2:6] - 2, at[2:6] - 1, pieces_, new[2:6])
    assert list(zip(a.tolist(), z.tolist())) == [(0, 2), (2, 4)]
    with pytest.raises(ValueError):
        charsmap.project(np.array([0, 1]), lengths, at[2:4] - 2, at[2:4] - 1, pieces_, new[2:4])
