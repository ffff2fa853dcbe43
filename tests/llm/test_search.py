import math
import random

from pyspark.sql import functions as F

from scriptorium.llm import vector_search
from scriptorium.llm.vector_search import top_k
from tests.llm.helpers import frame

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    held = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(held):
        if q is None or q % every:
            continue
        scored = [(-min(max(sum(s * t for s, t in zip(x, y)), -2**63), 2**63 - 1), i is None, i) for b, (i, y) in enumerate(held) if a != b]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def cases(width):
    rng = random.Random(7)
    rows = [(i, [rng.choice([rng.gauss(0, 0.2), 0.25]) for _ in range(width)]) for i in range(150)]
    rows += [(150 + i, rows[20][1]) for i in range(40)]  # ties
    rows += [(300, None), (305, [None] + [0.0] * (width - 1)), (310, [float("nan")] * width), (315, [float("inf")] * width),
             (320, []), (325, [0.5]), (20, rows[3][1]), (None, rows[20][1]), (2 ** 63 - 1, rows[20][1]), (-2 ** 63, rows[20][1])]
    return [(i, v if v is None else [x if x is None else float.fromhex(float(x).hex()) for x in v]) for i, v in rows]


def as_floats(spark, rows):
    """Rows as they are after the table's float type."""
    df = spark.createDataFrame(rows, SCHEMA)
    return [(r.vec_id, r.embedding) for r in df.collect()]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERY_ROWS", 7)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 31)
    for width in (5, 24):
        rows = as_floats(spark, cases(width))
        df = frame(spark, rows, SCHEMA, ["row", "score", "rank", "floor"])
        got = top_k(df, F.col("vec_id") % 5 == 0, k=6).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute(rows, 5, 6)


def test_fewer_rows_huge_values_and_empty(spark):
    rows = as_floats(spark, [(0, [1e9, 2.0]), (1, [3e8, 1.0]), (2, [-1e9, 5.0])])
    got = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 2 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 20)
    assert top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
