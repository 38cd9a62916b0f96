"""Vectorised helpers inside tasks: bytes of an Arrow column, word spans, word and range hashes, sliding minima.

Everything works on slices of about a quarter megabyte of text, so a task holds a fixed multiple of that, whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
BASE = 0x9E3779B97F4A7C15
ODD = np.uint64(0xD6E8FEB86659FD93)
STEP = np.uint64(0xCA5A826395121157)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[ord("A"):ord("Z") + 1] = True
IS_LETTER[ord("a"):ord("z") + 1] = True
IS_LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_held: dict[int, np.ndarray] = {}


def held_powers(base: int, n: int) -> np.ndarray:
    """powers, remembered by the worker up to two slices' length."""
    if n > 2 * SLICE:
        return powers(base, n)
    if base not in _held:
        _held[base] = powers(base, 2 * SLICE)
    return _held[base][:max(n, 1)]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD
    return h ^ (h >> np.uint64(29))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ends (0 first) of a string or binary column; nulls count as empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[:ends[-1]], ends


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, ends) of runs of rows of about size bytes; a longer text is a run of its own."""
    data, ends = texts(column)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
        yield i, j, data[ends[i]:ends[j]], ends[i:j + 1] - ends[i]
        i = j


def spans(data: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; inside: which bytes belong to words (default: all but white space)."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~IS_SPACE[data] if inside is None else inside[data]
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of every span's bytes, in blocks of about a slice. Spans ascend and do not overlap."""
    out = np.empty(len(first), np.uint64)
    i = 0
    while i < len(first):
        a = int(first[i])
        j = max(i + 1, int(np.searchsorted(last, a + SLICE, "right")))
        out[i:j] = range_hashes(TABLE[data[a:int(last[j - 1])]], first[i:j] - a, last[i:j] - a, 5)
        i = j
    return out


def range_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray, levels: int = 8) -> np.ndarray:
    """64-bit hash of values[first:last] for many ranges, which may overlap; depends on content only.

    A range is covered by two of the blocks of 2**k values that doubling gives, mixed without linear structure, so that
    no family of texts collides by construction. Ranges of 2**(levels + 1) values and more are digested one by one.
    """
    size = last - first
    level = np.frexp(np.maximum(size, 1))[1] - 1
    out = np.zeros(len(first), np.uint64)
    h = mixed(values * np.uint64(BASE))
    spare, other = np.empty_like(h), np.empty_like(h)
    for k in range(min(levels, int(level.max(initial=0))) + 1):
        if k:
            h, spare = _joined(h, 1 << (k - 1), spare, other), h
        some = np.flatnonzero((level == k) & (size > 0))
        if len(some):
            out[some] = h[first[some]] * ODD + mixed(h[last[some] - (1 << k)] + size[some].astype(np.uint64) * np.uint64(BASE))
    for i in np.flatnonzero(level > levels).tolist():
        digest = blake2b(values[first[i]:last[i]].tobytes(), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return mixed(out)


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` values from each place on, by doubling."""
    if len(values) < size:
        return np.empty(0, np.uint64)
    h, have = mixed(values * np.uint64(BASE)), 1
    spare, other = np.empty_like(h), np.empty_like(h)
    while have < size:
        step = min(have, size - have)
        h, spare = _joined(h, step, spare, other), h
        have += step
    return h * np.uint64(BASE)


def _joined(h: np.ndarray, step: int, into: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Hash of the block at each place and the one step after it, in memory that is there already."""
    n = len(h) - step
    np.multiply(h[:n], ODD, out=into[:n])
    np.multiply(h[step:], STEP, out=other[:n])
    into[:n] += other[:n]
    np.right_shift(into[:n], np.uint64(32), out=other[:n])
    into[:n] ^= other[:n]
    return into[:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width values."""
    if len(values) < width:
        return np.empty(0, values.dtype)
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
