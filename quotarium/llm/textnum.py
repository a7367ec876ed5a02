"""Words of many texts as numpy arrays, straight from Arrow's buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _STEP), _powers(_INVERSE, _STEP)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    _, at, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(at, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a text's end is a word's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word, after A-Z to a-z if asked; in blocks, so memory doesn't follow a long text."""
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _STEP, side="right"))
        if j <= i:  # one word longer than a block: piece by piece
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for a in range(int(starts[i]), int(ends[i]), _STEP):
                    part = data[a : min(a + _STEP, int(ends[i]))]
                    h = mix(np.array([h + (_TABLE[LOWER[part] if lower else part] * _UP[: len(part)]).sum()], dtype=np.uint64))[0]
            out[i] = h
            i += 1
            continue
        a = int(starts[i])
        part = data[a : int(ends[j - 1])]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[LOWER[part] if lower else part] * _UP[: len(part)], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * _DOWN[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(col: pa.Array, words: int = 3, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; a text of fewer words is one shingle, one of no words has none."""
    data, offsets = buffers(col)
    starts, ends = spans(data, offsets)
    h = word_hashes(data, starts, ends, lower)
    cut = np.searchsorted(starts, offsets)
    seeds = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 2**64) | 1) for k in range(words)]
    n = max(0, len(h) - words + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for k, seed in enumerate(seeds):
        grams += h[k : k + n] * seed
    grams = mix(grams)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for k in range(b - a):
                    whole = whole + h[a + k] * seeds[k]
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(grams[:0])
    return out
