"""Exact byte-pair encoding for many texts at once.

Tokens of a text are found word by word: no merge crosses a word's end, so its
ids don't depend on its neighbours. Ids of words are remembered in a bounded dictionary of the
Python worker; words not seen yet are merged together, vectorised over all of them. Texts that
hold characters outside a checked set go to the library itself.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quotarium.llm.textnum import buffers

INF = np.int32(2**31 - 1)
LONGEST_WORD = 160
CACHE_ENTRIES = 400_000
#: Words that are told apart at once.
BLOCK = 1 << 20


class PairMerger:
    """Merges by rank, leftmost first, for many symbol sequences together. Symbols are below `symbols`."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray, symbols: int):
        self.symbols = symbols
        self.kind = np.uint32 if symbols**2 < 2**32 - 1 else np.uint64
        self.none = self.kind(np.iinfo(self.kind).max)
        self.mult = self.kind(0x9E3779B1 if self.kind is np.uint32 else 0x9E3779B97F4A7C15)
        keys = self._keys(left, right)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = self.kind(8 * self.kind().itemsize - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self.none)
        self.rank = np.full(1 << bits, INF)
        self.merged = np.zeros(1 << bits, dtype=self.kind)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            first = np.zeros(len(todo), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.keys[slot] == self.none)
            self.keys[slot[put]], self.rank[slot[put]], self.merged[slot[put]] = keys[todo[put]], rank[todo[put]], merged[todo[put]]
            todo, slot = todo[~put], (slot[~put] + 1) & self.mask

    def _keys(self, left, right):
        return left.astype(self.kind, copy=False) * self.kind(self.symbols) + right.astype(self.kind, copy=False)

    def _slot(self, keys):
        return ((keys * self.mult) >> self.shift).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (INF: no merge) and its slot."""
        at = self._slot(keys)
        found = self.keys[at]
        out = self.rank[at]
        odd = found != keys
        out[odd] = INF
        left = np.flatnonzero(odd & (found != self.none))
        slot = at[left]
        while len(left):
            slot = (slot + 1) & self.mask
            found, k = self.keys[slot], keys[left]
            hit = found == k
            out[left[hit]], at[left[hit]] = self.rank[slot[hit]], slot[hit]
            go = ~hit & (found != self.none)
            left, slot = left[go], slot[go]
        return out, at

    def merge(self, sym: np.ndarray, lens: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """sym: symbols of all sequences, one after another; lens: at least 1 each. Returns the same two after merging."""
        ends = np.r_[0, np.cumsum(lens)]
        order = np.argsort(lens, kind="stable")  # sequences of like length end together
        flat, sizes, owners = [], [], []
        for i in range(0, len(lens), block):
            own = order[i : i + block]
            n = lens[own]
            at = np.arange(n.sum()) + np.repeat(ends[own] - (np.cumsum(n) - n), n)
            self._merge(sym[at].astype(self.kind), n, own, flat, sizes, owners)
        if not flat:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        flat, sizes, owners = np.concatenate(flat), np.concatenate(sizes), np.concatenate(owners)
        back = np.argsort(owners)
        n = sizes[back]
        return flat[np.arange(n.sum()) + np.repeat((np.cumsum(sizes) - sizes)[back] - (np.cumsum(n) - n), n)], n

    def _merge(self, sym, lens, owner, flat, sizes, owners) -> None:
        while len(owner):
            ends = np.cumsum(lens)
            starts = ends - lens
            rank, slot = self.lookup(self._keys(sym, np.r_[sym[1:], sym[:1]]))
            rank[ends - 1] = INF
            low = np.minimum.reduceat(rank, starts)
            if (done := low == INF).any():
                stay = np.repeat(~done, lens)
                flat.append(sym[~stay]), sizes.append(lens[done]), owners.append(owner[done])
                sym, rank, slot = sym[stay], rank[stay], slot[stay]
                owner, lens, low = owner[~done], lens[~done], low[~done]
                if not len(owner):
                    break
            seq = np.repeat(np.arange(len(owner)), lens)
            at = np.flatnonzero(rank == low[seq])
            own = seq[at]
            at = at[np.r_[True, own[1:] != own[:-1]]]
            sym[at] = self.merged[slot[at]]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            sym, lens = sym[stay], lens - 1


class PieceEncoder:
    """A sentencepiece model through its own library: ids without begin and end ids."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, col: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column, as unsigned 32-bit integers; null counts as empty."""
        return [np.array(x, dtype="<u4") for x in self.lib.encode([t or "" for t in col.to_pylist()], num_threads=1)]


#: What the word tokenizer's steps treat alike in the library and here.
_UNSAFE = "[^\\t\\n\\x0b\\x0c\\r\\x20-\\x7e¡-¬®-įı-ſ‐-‟…]|<\\|"
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _byte_chars() -> list[str]:
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], n = chr(256 + n), n + 1
    return out


#: Kinds of bytes: white space, letters, digits, anything else.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[48:58] = _DIGIT
#: Characters from U+00A1 to U+00F7 whose kind their first byte doesn't tell.
_ODD_KINDS = {_LETTER: "ªµº", _DIGIT: "²³¹¼½¾", _OTHER: "×÷"}
_TAILS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8 text of the checked set: that of its character."""
    kind = _KIND[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        pair = data[lead].astype(np.uint16) << 8 | data[lead + 1]
        for k, chars in _ODD_KINDS.items():
            kind[lead[np.isin(pair, [int.from_bytes(c.encode()) for c in chars])]] = k
        kind[lead + 1] = kind[lead]
        three = lead[data[lead] >= 0xE0]
        kind[three + 2] = kind[three]
    return kind


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin in lower-cased texts of the checked set, as _SPLIT finds them; a word takes the white space before it along, so words tile the texts."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    kind = _kinds(data)
    first = np.zeros(len(data) + 1, dtype=bool)
    head = (data & 0xC0) != 0x80
    first[1:-1] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE) | (kind[1:] == _DIGIT) & (kind[:-1] == _DIGIT)
    first[:-1] &= head
    first[offsets] = True
    # an apostrophe that begins a word takes one of some endings along
    mark = np.flatnonzero(data == 39)
    mark = mark[(mark == 0) | first[mark] | (kind[mark - 1] == _SPACE)]
    if len(mark):
        room = offsets[np.searchsorted(offsets, mark, side="right")] - mark
        padded = np.r_[data, np.zeros(3, np.uint8)]
        for tail in _TAILS:
            at = mark[(room > len(tail)) & np.all([padded[mark + 1 + i] == c for i, c in enumerate(tail)], axis=0)]
            first[at + 1], first[at + 1 + len(tail)] = False, True
    return np.flatnonzero(first[:-1])


class WordEncoder:
    """A tokenizers file: ids without added special tokens; strings of special tokens in a text count as the library's default does.

    Words are told apart by Arrow, so only a block's distinct words meet Python. Their ids lie in one growing array, and the ids of all
    texts of a block are gathered from it at once.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        self.fast = (
            spec["normalizer"] == _NORMAL and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout") and not model.get("ignore_merges")
            and spec["truncation"] is None and spec["padding"] is None and spec["post_processor"] is None and all(t["content"].startswith("<|") for t in spec["added_tokens"])
            and pre.get("pretokenizers", [{}])[0].get("pattern") == {"Regex": _SPLIT} and not pre["pretokenizers"][1]["add_prefix_space"]
        )
        if not self.fast:
            return
        vocab, chars = model["vocab"], _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + "</w>"] for c in chars], dtype=np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merger = PairMerger(*(np.array(x, dtype=np.int64) for x in zip(*((vocab[a], vocab[b], r, vocab[a + b]) for r, (a, b) in enumerate(merges)))), max(vocab.values()) + 1)
        self.entries = entries
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.cuts = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def encode(self, col: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column, as unsigned 32-bit integers; null counts as empty."""
        col = pc.fill_null(col, "")
        safe = np.zeros(len(col), bool) if not self.fast else ~pc.match_substring_regex(col, _UNSAFE).to_numpy(zero_copy_only=False)
        data, offsets = buffers(pc.utf8_lower(col if safe.all() else col.filter(pa.array(safe))))
        starts = word_starts(data, offsets)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, len(data)].astype(np.int32)), pa.py_buffer(data))
        ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), BLOCK):
            coded = words.slice(k, BLOCK).dictionary_encode()
            own = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
            begin = self.cuts[own]
            size = self.cuts[own + 1] - begin
            ids.append(self.flat[np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)])
            sizes.append(size)
        flat, total = np.concatenate(ids), np.r_[0, np.cumsum(np.concatenate(sizes))]
        at = total[np.searchsorted(starts, offsets)].tolist()
        fast = iter(zip(at[:-1], at[1:]))
        return [flat[slice(*next(fast))] if s else self.whole(col[i].as_py()) for i, s in enumerate(safe.tolist())]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _slots(self, words: list[str]) -> np.ndarray:
        """The place of each of some distinct words in the array of known ids."""
        if len(self.slots) + len(words) > self.entries:
            self._forget()
        get = self.slots.get
        at = [get(w) for w in words]
        if new := [w for w, k in zip(words, at) if k is None]:
            learned, sizes = self._learn([w.lstrip("\t\n\x0b\x0c\r ").encode() for w in new])
            self.flat, self.cuts = np.concatenate([self.flat, learned]), np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(sizes)])
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
            at = [get(w) for w in words]
        return np.array(at, dtype=np.int64)

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, one after another, and how many each has. White space alone has none."""
        sizes = np.zeros(len(words), dtype=np.int64)
        merged = [k for k, w in enumerate(words) if 0 < len(w) <= LONGEST_WORD]
        raw = [words[k] for k in merged]
        lens = np.array([len(r) for r in raw], dtype=np.int64)
        points = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym, last = self.inner[points], np.cumsum(lens) - 1
        sym[last] = self.final[points[last]]
        flat, sizes[merged] = self.merger.merge(sym, lens)
        if not (long := [k for k, w in enumerate(words) if len(w) > LONGEST_WORD]):
            return flat.astype("<u4"), sizes
        own = dict(zip(merged, np.split(flat.astype("<u4"), np.cumsum(sizes[merged])[:-1]))) | {k: self.whole(words[k].decode()) for k in long}
        sizes[long] = [len(own[k]) for k in long]
        return np.concatenate([own[k] for k in sorted(own)]), sizes


@functools.cache
def encoder(path: str) -> WordEncoder | PieceEncoder:
    """One encoder for each file and Python worker."""
    return PieceEncoder(path) if path.endswith(".model") else WordEncoder(path)
