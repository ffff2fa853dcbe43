"""Word spans and word hashes of whole Arrow text columns, with numpy.

Texts are handled as UTF-8 bytes, several documents at a time: one byte table
decides which bytes belong to words. Words have two hashes: ``word_hashes``
mixes their blocks and stands for the word; ``span_hashes`` takes any spans
from one running polynomial sum and is for features alone, since two long
words built for it can have the same. A slice holds whole documents
and about ``SLICE_BYTES`` bytes (a longer document is a slice of its own), so
memory in a worker does not depend on the Arrow batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SEGMENT = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf, off


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of whole documents, each of about ``limit`` bytes."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + limit // 16)
        yield lo, hi
        lo = hi


@dataclass
class Words:
    """Words of a slice: byte spans in ``data`` and, by document, the range
    ``first[d]:first[d + 1]`` of word numbers."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def texts(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[s:e] for s, e in zip(self.start[which].tolist(), self.end[which].tolist())]


def word_array(words: Words, fold_case: bool = True) -> pa.Array:
    """The words themselves, in order, as one Arrow column; ``fold_case``
    gives A-Z as a-z."""
    step = np.zeros(len(words.data) + 1, np.int8)
    step[words.start] += 1
    step[words.end] -= 1
    held = words.data[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    if fold_case:
        held = _LOWER[held]
    offsets = np.concatenate([[0], np.cumsum(words.end - words.start)])
    return pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: bytes) -> np.ndarray:
    """Table of the bytes that belong to words: all but ``separators``."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def split_words(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes inside each document of ``off``."""
    base, local = off[0], off - off[0]
    docs = len(off) - 1
    # one closing byte per document keeps runs of neighbours apart
    data = np.insert(buf[base:off[-1]], local[1:], 0)
    closing = local[1:] + np.arange(docs)
    mask = is_word[data]
    mask[closing] = False
    step = np.diff(mask.view(np.int8), prepend=np.int8(0))
    start = np.flatnonzero(step == 1)
    end = np.flatnonzero(step == -1)
    first = np.concatenate([[0], np.searchsorted(start, closing)])
    return Words(data, start, end, first)


def _byte_values(seed: int, fold_case: bool) -> np.ndarray:
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
    if fold_case:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _byte_values(20240229, fold) for fold in (False, True)}
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, _SEGMENT + 4096)
        inverse = pow(_MULT, -1, 1 << 64)
        both = []
        for factor in (_MULT, inverse):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of every span; spans are in order of their
    starts. ``fold_case`` treats A-Z as a-z."""
    out = np.empty(len(start), np.uint64)
    values = _VALUES[fold_case]
    i = 0
    while i < len(start):
        base = start[i]
        j = max(i + 1, int(np.searchsorted(start, base + _SEGMENT)))
        stop = int(end[i:j].max())
        power, inverse = _powers(stop - base + 1)
        sums = np.empty(stop - base + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[base:stop]] * power[:stop - base], out=sums[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


_LONG_WORD = 64


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of every word, eight bytes after eight, each
    mixed with all before; words over ``_LONG_WORD`` bytes by xxh3.
    ``fold_case`` treats A-Z as a-z."""
    if not len(start):
        return np.empty(0, np.uint64)
    held = np.zeros(len(data) + 8, np.uint8)
    held[:len(data)] = _LOWER[data] if fold_case else data
    eight = np.ndarray(len(data) + 1, "<u8", held, strides=(1,))
    n = end - start
    h = mix(n.astype(np.uint64) * np.uint64(_MULT) + np.uint64(1))
    rows = np.flatnonzero(n <= _LONG_WORD)
    at = 0
    while len(rows):
        bits = np.minimum(n[rows] - at, 8).astype(np.uint64) * np.uint64(8)
        block = eight[start[rows] + at] & (~np.uint64(0) >> (np.uint64(64) - bits))
        h[rows] = mix(h[rows] * np.uint64(_MULT) + block)
        at += 8
        rows = rows[n[rows] > at]
    long = np.flatnonzero(n > _LONG_WORD)
    if len(long):
        raw = memoryview(held)
        h[long] = [xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(start[long].tolist(), end[long].tolist())]
    return h


def combine(parts: list[np.ndarray], tag: int = 0) -> np.ndarray:
    """Order-dependent hash of several hashes."""
    h = np.full(len(parts[0]), np.uint64(tag * 0x2545F4914F6CDD1D % (1 << 64) + 1), np.uint64)
    for p in parts:
        h = mix(h * np.uint64(_MULT) + p)
    return h
