"""The parts of a sentencepiece model file that normalisation needs, and normalisation with source alignment.

A compiled character map holds a double-array trie of source prefixes and a blob of replacement
strings. At each place of a text the longest prefix in the trie is replaced; a place with no such
prefix keeps its character. Each byte of the result remembers the span of source bytes it came from.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

MARK = "▁".encode()
#: Kind of the pieces that a user defined, in a model file.
USER_DEFINED = 4


def _fields(b: bytes):
    i = 0

    def varint():
        nonlocal i
        shift = value = 0
        while True:
            x = b[i]
            i += 1
            value |= (x & 127) << shift
            shift += 7
            if x < 128:
                return value

    while i < len(b):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, b[i : i + n]
            i += n


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    is_bpe: bool = False
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trims: bool = True
    escapes: bool = True


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        raw = f.read()
    m = PieceModel()
    for k, v in _fields(raw):
        if k == 1:
            p = dict(_fields(v))
            m.pieces.append(p.get(1, b"").decode())
            m.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
            m.kinds.append(p.get(3, 1))
        elif k == 2:
            t = dict(_fields(v))
            m.is_bpe, m.byte_fallback = t.get(3, 1) == 2, bool(t.get(35, 0))
        elif k == 3:
            n = dict(_fields(v))
            m.charsmap, m.dummy_prefix, m.trims, m.escapes = n.get(2, b""), bool(n.get(3, 1)), bool(n.get(4, 1)), bool(n.get(5, 1))
    return m


class Normalizer:
    """Longest-prefix normalisation through a compiled character map, keeping the source of each byte. Pieces that a user defined stay as they are."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool = True, trims: bool = False, escapes: bool = True, defined: Iterable[str] = ()):
        self.own: dict[int, list[bytes]] = {}
        for d in sorted((d.encode() for d in defined), key=len, reverse=True):
            self.own.setdefault(d[0], []).append(d)
        self.units: tuple[int, ...] = ()
        self.blob = b""
        if charsmap:
            (size,) = struct.unpack_from("<I", charsmap)
            self.units = struct.unpack_from(f"<{size // 4}I", charsmap, 4)
            self.blob = charsmap[4 + size :]
        self.dummy_prefix, self.trims, self.escapes = dummy_prefix, trims, escapes

    def longest(self, text: bytes, at: int) -> tuple[int, int]:
        """Length of the longest source prefix at a place and the offset of its replacement; length 0 if none."""
        units, best = self.units, (0, 0)
        node = 0
        unit = units[0]
        base = (unit >> 10) << ((unit & 512) >> 6)
        node ^= base
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        return best

    def _parts(self, text: bytes):
        """(replacement, source start, source end) from left to right."""
        i = 0
        while i < len(text):
            kept = next((d for d in self.own.get(text[i], ()) if text.startswith(d, i)), None) if self.own else None
            n, to = (0, 0) if kept or not self.units else self.longest(text, i)
            if kept:
                n = len(kept)
                yield kept, i, i + n
            elif n:
                yield self.blob[to : self.blob.index(b"\0", to)], i, i + n
            else:
                b = text[i]
                n = 1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                yield text[i : i + n], i, i + n
            i += n

    def align(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The normalised text, and for each of its bytes the start and end of its source.

        The dummy prefix has the empty source span at 0, or behind the spaces that are trimmed. Bytes of one replacement share its span.
        """
        if not self.units and not self.trims and not self.own:
            return self._align_identity(text)
        space = MARK if self.escapes else b" "
        parts = list(self._parts(text))
        lead = 0
        if self.trims:
            lead = next((a for new, a, _ in parts if new != b" "), 0)
            kept, blank = [], True
            for new, a, b in parts:
                while blank and new.startswith(b" "):
                    new = new[1:]
                if new:
                    kept.append((new, a, b))
                    blank = new.endswith(b" ")
            while kept and kept[-1][0].endswith(b" "):
                new, a, b = kept.pop()
                if new := new.rstrip(b" "):
                    kept.append((new, a, b))
            parts = kept
        if self.dummy_prefix and parts:
            parts = [(b" ", lead, lead), *parts]
        out, start, end = [], [], []
        for new, a, b in parts:
            new = new.replace(b" ", space)
            out.append(new)
            start += [a] * len(new)
            end += [b] * len(new)
        return b"".join(out), np.array(start, dtype=np.int64), np.array(end, dtype=np.int64)

    def _align_identity(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if not text:
            return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = np.frombuffer(text, dtype=np.uint8)
        begins = (data & 0xC0) != 0x80
        at = np.flatnonzero(begins)
        size = np.diff(np.r_[at, len(data)])
        grown = np.where((data[at] == 32) & self.escapes, len(MARK), size)
        start, end = np.repeat(at, grown), np.repeat(at + size, grown)
        new = text.replace(b" ", MARK) if self.escapes else text
        if self.dummy_prefix:
            lead = MARK if self.escapes else b" "
            zero = np.zeros(len(lead), dtype=np.int64)
            new, start, end = lead + new, np.r_[zero, start], np.r_[zero, end]
        return new, start, end


def piece_lengths(m: PieceModel) -> np.ndarray:
    """Bytes that each piece covers in normalised text; -1 for the unknown piece, 0 for control pieces."""
    return np.array([1 if k == 6 else 0 if k == 3 else -1 if k == 2 else len(p.encode()) for p, k in zip(m.pieces, m.kinds)], dtype=np.int64)


def _with_unknown(ids: np.ndarray, size: np.ndarray, pieces: list[str], new: bytes) -> np.ndarray:
    """Sizes where unknown pieces (-1) get theirs: each takes what stands before the pieces that follow it, at least one character."""
    size, at, unknown = size.copy(), 0, np.flatnonzero(size < 0).tolist()
    for k, i in enumerate(unknown):
        at += int(size[unknown[k - 1] + 1 if k else 0 : i].sum())
        last = k + 1 == len(unknown)
        after = "".join(pieces[x] for x, n in zip(ids[i + 1 : None if last else unknown[k + 1]].tolist(), size[i + 1 :].tolist()) if n > 0).encode()
        end = len(new) - len(after) if last else new.find(after, at + 1)
        if end <= at:
            raise ValueError("pieces don't cover the normalised text")
        size[i] = end - at
        at = end
    return size


def project(ids: np.ndarray, lengths: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: list[str] | None = None, new: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Source byte span of each piece. Unknown pieces take what the other pieces, found one after another in the normalised text, leave."""
    size = lengths[ids]
    if (size < 0).any():
        size = _with_unknown(ids, size, pieces or [], new)
    stop = np.cumsum(size)
    if len(stop) and stop[-1] != len(start):
        raise ValueError("pieces don't cover the normalised text")
    first = stop - size
    n = len(start)
    if not n:
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    a = start[np.minimum(first, n - 1)]
    b = end[np.maximum(stop - 1, 0)]
    empty = size == 0
    a[empty] = np.where(first[empty] == 0, 0, end[np.maximum(first[empty] - 1, 0)])
    b[empty] = a[empty]
    return a, b
