"""Hashed text features of whole Arrow text columns, and small-model helpers."""

from __future__ import annotations

import numpy as np

from scriptorium.llm.textbytes import combine, span_hashes


def buckets(hashes: np.ndarray, tag: int, size: int) -> np.ndarray:
    """Hashes of one kind (``tag``) as feature numbers below ``size``."""
    return (combine([hashes], tag=tag) % np.uint64(size)).astype(np.int64)


def prefix_buckets(words, lengths: tuple[int, ...], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for every word of a slice and for its first
    ``length`` bytes, for each length that it has."""
    doc, n = words.doc, words.end - words.start
    docs, out = [doc], [buckets(span_hashes(words.data, words.start, words.end), 0, size)]
    for length in lengths:
        long = np.flatnonzero(n >= length)
        start = words.start[long]
        docs.append(doc[long])
        out.append(buckets(span_hashes(words.data, start, start + length), length, size))
    return np.concatenate(docs), np.concatenate(out)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
