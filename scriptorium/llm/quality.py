"""Quality by ordinal regression on graded ratings.

A cumulative-link (proportional odds) model: one weight vector over hashed
text features, shared by all grades, and ordered thresholds between them,
``P(grade <= k) = sigmoid(threshold_k - weights . features)``. It gives the
expected grade and the probability of a grade or better, by which documents
are selected.

Features of a text are shares of its tokens (square roots of relative
frequencies): the words themselves, the shapes of their first and last three
bytes, words that repeat the one before, and the share of repeated words.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.features import buckets, sigmoid
from scriptorium.llm.shared import freeing, qualified, read_bytes, write_bytes
from scriptorium.llm.textbytes import byte_class, slices, span_hashes, split_words, utf8
from scriptorium.session import scratch_path

WIDTH = 1 << 12
# the model is fitted on this many rated rows
SAMPLE_DOCS = 10_000
# probabilities that are held at a time
CELLS = 1 << 20
STEPS, RATE, DECAY = 200, 0.3, 1e-6

TOKEN_BYTES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("9")
SHAPE_BYTES = 3


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of rows ``lo:hi``: (document, feature, value), by document."""
    buf, off = utf8(column)
    for lo, hi in slices(off):
        w = split_words(buf, off[lo:hi + 1], TOKEN_BYTES)
        doc, n = w.doc, np.diff(w.first)
        shape = _SHAPE[w.data]
        word = span_hashes(w.data, w.start, w.end)
        head = span_hashes(shape, w.start, np.minimum(w.end, w.start + SHAPE_BYTES), fold_case=False)
        tail = span_hashes(shape, np.maximum(w.start, w.end - SHAPE_BYTES), w.end, fold_case=False)
        same = np.zeros(len(word), bool)
        same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
        kinds = [buckets(word, 0, WIDTH), buckets(head, 1, WIDTH), buckets(tail, 2, WIDTH),
                 buckets(same.astype(np.uint64), 3, WIDTH)]
        key, count = np.unique(np.concatenate([doc * WIDTH + k for k in kinds]), return_counts=True)
        value = np.sqrt(count / n[key // WIDTH])
        # the share of tokens that are not the first of their word
        order = np.lexsort((word, doc))
        again = np.zeros(len(word), bool)
        again[1:] = (word[order][1:] == word[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        share = np.bincount(doc[order], again, hi - lo) / np.maximum(n, 1)
        held = np.flatnonzero(n)
        extra = held * WIDTH + int(buckets(np.zeros(1, np.uint64), 4, WIDTH)[0])
        key, value = np.concatenate([key, extra]), np.concatenate([value, share[held]])
        order = np.argsort(key, kind="stable")
        yield lo, hi, key[order] // WIDTH, key[order] % WIDTH, value[order]


@dataclass
class Model:
    """``grades`` ascending, one threshold between each two."""

    grades: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, s: np.ndarray) -> np.ndarray:
        """Probability of each grade or better, by text (first column 1)."""
        up = 1 - sigmoid(self.thresholds[None, :] - s[:, None])
        return np.concatenate([np.ones((len(s), 1)), up], 1)

    def expected(self, s: np.ndarray) -> np.ndarray:
        steps, rows = np.diff(self.grades, prepend=0.0), max(1, CELLS // max(1, len(self.grades)))
        return np.concatenate([self.at_least(s[i:i + rows]) @ steps for i in range(0, max(1, len(s)), rows)])

    def tail(self, s: np.ndarray, grade: float) -> np.ndarray:
        """Probability of ``grade`` or better."""
        at = int(np.searchsorted(self.grades, grade))
        if at == 0:
            return np.full(len(s), float(len(self.grades) > 0))
        return 1 - sigmoid(self.thresholds[at - 1] - s) if at < len(self.grades) else np.zeros(len(s))


def fit(grade: np.ndarray, doc: np.ndarray, feature: np.ndarray, value: np.ndarray) -> Model:
    """Weights and ordered thresholds, by AdaGrad on the whole sample."""
    grades, y = np.unique(grade, return_inverse=True)
    n, k = len(y), len(grades)
    if k == 0:
        return Model(np.zeros(1), np.zeros(WIDTH), np.zeros(0))
    below = np.cumsum(np.bincount(y, minlength=k))[:-1] / n
    cut = np.log(below / (1 - below))
    # thresholds are the first one and the logarithms of the steps above it
    free = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))])
    weights, squares, steps = np.zeros(WIDTH), np.full(WIDTH, 1e-8), np.full(len(free), 1e-8)
    for _ in range(STEPS if k > 1 else 0):
        cut = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        s = np.bincount(doc, weights[feature] * value, n)
        edges = np.concatenate([[-np.inf], cut, [np.inf]])
        upper, lower = sigmoid(edges[y + 1] - s), sigmoid(edges[y] - s)
        p = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / p / n, lower * (1 - lower) / p / n
        slope = np.bincount(feature, (up - down)[doc] * value, WIDTH) + DECAY * weights
        by_cut = np.bincount(y, -up, k)[:k - 1] + np.bincount(y, down, k)[1:]
        after = np.cumsum(by_cut[::-1])[::-1]
        by_free = np.concatenate([after[:1], after[1:] * np.exp(free[1:])])
        squares += slope ** 2
        steps += by_free ** 2
        weights -= RATE * slope / np.sqrt(squares)
        free -= RATE * by_free / np.sqrt(steps)
    cut = free[:1].sum() + np.concatenate([np.zeros(min(1, k - 1)), np.cumsum(np.exp(free[1:]))])
    return Model(grades, weights, cut)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in freeing(batches):
        for lo, hi, doc, feature, value in features(batch.column(0)):
            first = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(1).slice(lo, hi - lo).cast(pa.float64()),
                pa.ListArray.from_arrays(first, pa.array(feature.astype(np.int16))),
                pa.ListArray.from_arrays(first, pa.array(value.astype(np.float32))),
                batch.column(2).slice(lo, hi - lo),
            ], names=["grade", "feature", "value", "h"])


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality") -> str:
    """Fit a model on ``SAMPLE_DOCS`` rated rows, chosen by a hash of the id
    (rows of one id by a hash of the text), and store it in the shared folder;
    returns its path.

    Ratings with a null id or grade, or a grade that is not a number, take no
    part; a document rated more than once counts once for each different
    grade. A scale may have any number of grades. Without ratings, every text
    has the expected grade 0.
    """
    spark = docs.sparkSession
    rated = (
        ratings.select(F.col(id_col).cast("long").alias("doc_id"), F.col(grade_col).cast("double").alias("grade"))
        .where("doc_id is not null and grade is not null and not isnan(grade)").distinct()
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = (
        rated.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(SAMPLE_DOCS)
    )
    # at most SAMPLE_DOCS short rows: the texts stay where they are; an id may have any number of rows
    rows = texts.join(F.broadcast(some), "doc_id").select("text", "grade", F.xxhash64("doc_id", "text").alias("h")) \
        .mapInArrow(_sample, "grade double, feature array<smallint>, value array<float>, h long") \
        .orderBy("h", "grade").limit(SAMPLE_DOCS).toArrow()
    grade = rows["grade"].to_numpy()
    lists = [pa.chunked_array([c.flatten() for c in rows[name].chunks], kind) if rows.num_rows else pa.array([], kind)
             for name, kind in (("feature", pa.int16()), ("value", pa.float32()))]
    sizes = np.concatenate([c.value_lengths().to_numpy() for c in rows["feature"].chunks] or [np.empty(0, np.int64)])
    doc = np.repeat(np.arange(len(grade)), sizes)
    model = fit(grade, doc, lists[0].to_numpy().astype(np.int64), lists[1].to_numpy().astype(np.float64))
    return write_bytes(f"{qualified(spark, scratch_path(spark, 'quality'))}/model", pickle.dumps(model))


@functools.lru_cache(maxsize=2)
def _model(uri: str) -> Model:
    return pickle.loads(read_bytes(uri))


def _linear(column: pa.Array, model: Model) -> np.ndarray:
    out = np.zeros(len(column))
    for lo, hi, doc, feature, value in features(column):
        out[lo:hi] = np.bincount(doc, model.weights[feature] * value, hi - lo)
    return out


def score(docs: DataFrame, model: str, grade: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_grade, p_at_least`` (probability of ``grade`` or
    better) of every row, from its text alone. Null and empty texts have no
    features and get the model's value for that; repeated rows are scored
    each; other columns are ignored; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in freeing(batches):
            s = _linear(batch.column(1), m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(m.expected(s)), pa.array(m.tail(s, grade))],
                names=["doc_id", "expected_grade", "p_at_least"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, p_at_least double")


def select_good(docs: DataFrame, model: str, grade: float, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that reach ``grade`` with a
    probability of at least ``threshold``."""
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in freeing(batches):
            yield batch.filter(pa.array(m.tail(_linear(batch.column(text_at), m), grade) >= threshold))

    return docs.mapInArrow(run, docs.schema)
