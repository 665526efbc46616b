"""Vectorised words of Arrow text columns (numpy, whole batches at a time).

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``; A-Z are folded to
lower case.  Each word gets a 64-bit hash from one pass over the bytes: a
polynomial in a random byte alphabet, read off prefix sums modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20  # of text handled at a time (a longer document is a chunk of its own)
_RNG = np.random.default_rng(20240229)
_ALPHABET = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ALPHABET[65:91] = _ALPHABET[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_GRAM = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX[0]
    h ^= h >> np.uint64(27)
    h *= _MIX[1]
    h ^= h >> np.uint64(31)
    return h


def _power(n: int):
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(array):
    """(first row, last row + 1, bytes, offsets) of pieces of about CHUNK_BYTES."""
    data, offsets = utf8(array)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        to = min(rows, max(to, row + 1))
        yield row, to, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def word_spans(data, offsets, separators=_SPACE):
    """Starts and ends of the words (byte positions), and each row's first word number."""
    space = separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = ~space, ~space
    start[1:] &= space[:-1] | edge[1:-1]
    end[:-1] &= space[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_spans(data, starts, ends):
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_ALPHABET[data] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(array):
    """Per chunk: (first row, last row + 1, word hashes, each row's first word number)."""
    for row, to, data, offsets in chunks(array):
        starts, ends, first = word_spans(data, offsets)
        yield row, to, hash_spans(data, starts, ends), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (positions that have n words)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = words[:m] * _GRAM[0]
    for k in range(1, n):
        total += words[k:k + m] * _GRAM[k]
    return mix(total + _GRAM[32 + n % 32])


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles; fewer words: all of them as one shingle."""
    if 0 < len(words) < n:
        return gram_hashes(words, len(words))
    return np.unique(gram_hashes(words, n))
