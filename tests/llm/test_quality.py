import math
import random

import numpy as np

from scriptorium.llm import quality
from tests.llm.helpers import frame, text


def graded(rng, n):
    """Grade g of 0..3: the share of words that are junk falls with g."""
    rows = []
    for i in range(n):
        g = rng.randrange(4)
        words = text(rng, rng.randrange(40, 120)).split()
        rows.append((i, " ".join(w + "###" if rng.random() < (3 - g) * 0.25 else w for w in words), g))
    return rows


def test_held_out_grades(spark):
    rows = graded(random.Random(5), 600)
    docs = frame(spark, [r[:2] for r in rows], "doc_id long, text string", ["grade", "feature"])
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows if i % 4] + [(None, 2), (3, None), (99999, 1)], "doc_id long, quality int")
    model = quality.train(docs, ratings)
    got = {r.doc_id: r for r in quality.score(docs, model, grade=2).collect()}
    held = [(got[i], g) for i, _, g in rows if i % 4 == 0]
    assert np.mean([abs(r.expected_grade - g) for r, g in held]) < 0.4
    assert np.mean([(r.p_at_least >= 0.5) == (g >= 2) for r, g in held]) > 0.9
    kept = quality.select_good(docs, model, grade=2)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.p_at_least >= 0.5}


def test_thresholds_are_ordered():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 4, 300).astype(float)
    m = quality.fit(y, np.arange(300), np.zeros(300, np.int64), rng.random(300))
    assert (np.diff(m.thresholds) > 0).all()
    p = m.at_least(rng.normal(size=50))
    assert (np.diff(p, axis=1) <= 0).all() and (m.expected(np.zeros(1)) <= 3).all()


def test_edges(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "one"), (None, "x " * 50_000)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.expected_grade for r in quality.score(docs, quality.train(docs, none), 1).collect()} == {0.0}
    one = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    model = quality.train(docs, one)
    assert {r.expected_grade for r in quality.score(docs, model, 1).collect()} == {1.0}
    assert quality.score(docs.limit(0), model, 1).count() == 0


def negative_log_likelihood(y, s, cut):
    """Direct sums: the mean over all rows of -log(P(grade))."""
    edges = [-math.inf, *cut, math.inf]
    upto = lambda k, x: 0.0 if k == 0 else 1.0 if k == len(cut) + 1 else 1 / (1 + math.exp(-(edges[k] - x)))
    return -sum(math.log(upto(g + 1, x) - upto(g, x)) for g, x in zip(y, s)) / len(y)


def test_fit_is_a_minimum_of_the_direct_likelihood(monkeypatch):
    """No small step of any weight or threshold lowers the sum."""
    monkeypatch.setattr(quality, "STEPS", 4000)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (120, 3)).astype(float)
    y = np.clip(np.rint(x @ [2.0, -1.0, 0.5] + rng.normal(0, 1, 120) + 1), 0, 3)
    doc, feature = np.nonzero(x)
    m = quality.fit(y, doc, feature, x[doc, feature])
    w, cut = m.weights[:3], m.thresholds

    def loss(w, cut):
        return negative_log_likelihood(y.astype(int), x @ w, cut) + quality.DECAY / 2 * (w @ w)

    here = loss(w, cut)
    for i in range(3):
        for d in (-0.02, 0.02):
            assert loss(w + d * np.eye(3)[i], cut) > here and loss(w, cut + d * np.eye(3)[i]) > here
    s = x @ w
    direct = [sum(k * (1 / (1 + math.exp(-((list(cut) + [math.inf])[k] - v))) - (1 / (1 + math.exp(-(cut[k - 1] - v))) if k else 0))
                  for k in range(4)) for v in s.tolist()]
    assert np.allclose(m.expected(s), direct) and np.allclose(m.tail(s, 2), 1 - 1 / (1 + np.exp(-(cut[1] - s))))


def test_many_grades_and_rows_of_one_id(spark, monkeypatch):
    """A scale of more grades than any block holds, and a sample bounded in
    rows, not in ids."""
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 200)
    monkeypatch.setattr(quality, "CELLS", 100)
    rows = [(i, "word " * (1 + i % 80) + "x", i % 80) for i in range(160)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(0, f"copy {i}") for i in range(3000)], "doc_id long, text string")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda grade, *a: seen.append(len(grade)) or fit(grade, *a))
    model = quality.train(docs, spark.createDataFrame([(i, float(g)) for i, _, g in rows], "doc_id long, quality double"))
    assert seen == [200]
    out = quality.score(docs.limit(50), model, grade=5).collect()
    assert len(out) == 50 and all(0 <= r.p_at_least <= 1 and 0 <= r.expected_grade <= 79 for r in out)
