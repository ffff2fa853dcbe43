import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from scriptorium.llm import lexical_cse
from scriptorium.llm.lexical_cse import make_plan, mine, plan_items, search
from tests.llm.helpers import frame, text

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k):
    """Sorted ``(item, rank, doc, score)``, by direct sums."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, t in items:
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * c[x] // (1000 * c[x] + 8 * m))
                    for x in set(terms(t)) if c[x])
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus():
    rng = random.Random(31)
    docs = [(i * 7 - 100, text(rng, rng.choice([1, 5, 40, 300]))) for i in range(80)]
    docs += [(5000, docs[3][1]), (5000, docs[3][1]), (None, docs[3][1]), (None, None), (5001, ""), (5002, " .;\n"),
             (2 ** 63 - 1, docs[3][1]), (-2 ** 63, docs[3][1]), (5003, "ÉTÉ été Straße 日本 " * 20_000)]
    items = [(i, text(rng, 12)) for i in range(30)]
    items += [(3, items[5][1]), (3, items[5][1].upper()), (None, "River stone, 日本"), (70, None), (71, ""), (72, "..."), (73, "nowhere"), (74, "été É")]
    return docs, items


def test_against_direct_sums(spark):
    docs, items = corpus()
    d = frame(spark, docs, "doc_id long, text string", ["row", "term", "score"])
    q = frame(spark, items, "item_id long, text string", ["row", "terms", "block"])
    assert rows(search(d.repartition(5), q, k=10)) == brute(docs, items, 10)


def test_many_blocks_and_steps(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(lexical_cse, "BLOCK_TERMS", 40)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert plan_items(q).count() > 4
    assert rows(search(d, q, k=3)) == brute(docs, items, 3)
    small = make_plan(0, [0, 1], [0, 1], [["river", "stone"], ["river", "bridge"]])
    small.weights = np.array([5, 7, 11])
    whole = [(lo, s) for lo, s in _scores(small, 64, monkeypatch, 1 << 22)]
    parts = [(lo, s) for lo, s in _scores(small, 64, monkeypatch, 16)]
    assert len(whole) == 1 < len(parts)
    assert np.array_equal(whole[0][1], np.concatenate([s for _, s in parts], axis=1))


def _scores(plan, n, monkeypatch, cells):
    import pyarrow as pa

    monkeypatch.setattr(lexical_cse, "CELLS", cells)
    rng = random.Random(1)
    (part,) = lexical_cse._term_slices(pa.array(["river " + text(rng, 9) for _ in range(n)]))
    yield from lexical_cse._scored(plan, part, pa.array([t.encode() for t in plan.terms], pa.large_binary()), np.full(n, 100))


@pytest.mark.parametrize("seed", range(6))
def test_graph_sums_to_every_item(seed):
    rng = random.Random(seed)
    pool = [f"t{i}" for i in range(40)]
    shared = [rng.sample(pool, 6) for _ in range(4)]
    sets = [sorted({*rng.sample(pool, rng.randrange(1, 9)), *(rng.choice(shared) if rng.random() < 0.7 else [])}) for _ in range(30)]
    names, leaf, leaves, children, nodes = mine(sets)
    value = [Counter() for _ in range(leaves)]
    for t, n in zip(names, leaf.tolist()):
        value[n][t] += 1
    for a, b in children:
        value.append(value[a] + value[b])
    for own, want in zip(nodes, sets):
        assert sum((value[n] for n in own), Counter()) == Counter(want)
    plan = make_plan(0, list(range(30)), list(range(30)), sets)
    shared_adds, apart = plan.additions()
    assert shared_adds < apart == sum(len(s) - 1 for s in sets)


def test_repeated_items_share_one_node():
    names, leaf, leaves, children, nodes = mine([["a", "b", "c"]] * 5)
    assert (leaves, children, nodes) == (1, [], [[0]] * 5)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "river")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert search(docs, asked).count() == search(some, items).count() == search(docs, items).count() == 0
    assert search(docs, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_lengths_beyond_64_bits():
    n = np.array([0, 10 ** 9, 3 * 10 ** 9])
    assert lexical_cse._lengths(n, 10 ** 12, 10 ** 14).tolist() == [10 + 90 * x * 10 ** 12 // 10 ** 14 for x in n.tolist()]
