"""Packing: brute-force comparison, edge cases, partition independence."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import pack as P
from scriptorium.operators.ordering import exclusive_running_sum, global_row_index


def brute(docs, L):
    stream = [t for _, ids in sorted(docs) for t in ids]
    n = len(stream) // L
    return [stream[i * L:(i + 1) * L] for i in range(n)], len(stream)


def _df(spark, docs, parts=None):
    df = spark.createDataFrame(docs, "ord long, input_ids array<int>")
    return df.repartition(parts) if parts else df


def _packed(df, L, **kw):
    rows = P.pack_sequences(df, L, **kw).orderBy("seq_id").collect()
    assert [r.seq_id for r in rows] == list(range(len(rows)))
    for r in rows:
        assert r.input_ids == r.labels
    return [list(r.input_ids) for r in rows]


def _random_docs(seed, n=60):
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        size = rnd.choice([0, 1, 3, 7, 20, 45, 130])
        docs.append((i * 3 + rnd.randint(0, 2), [rnd.randint(0, 999) for _ in range(size)]))
    return docs


@pytest.mark.parametrize("L", [1, 7, 16, 64])
def test_matches_brute_force(spark, L):
    docs = _random_docs(L)
    expect, _ = brute(docs, L)
    assert _packed(_df(spark, docs), L) == expect


@pytest.mark.parametrize("parts,buckets", [(1, 1), (3, 2), (8, 5)])
def test_partition_independent(spark, parts, buckets):
    docs = _random_docs(99, 80)
    expect, _ = brute(docs, 16)
    assert _packed(_df(spark, docs, parts), 16, n_buckets=buckets) == expect


def test_shuffle_join_path(spark):
    docs = _random_docs(5)
    expect, _ = brute(docs, 10)
    assert _packed(_df(spark, docs), 10) == expect


def test_short_corpus_gives_no_rows(spark):
    df = _df(spark, [(0, [1, 2]), (1, [3])])
    assert P.pack_sequences(df, 8).count() == 0
    s = P.pack_stats(df, 8).first()
    assert (s.total_tokens, s.sequences, s.discarded_tokens) == (3, 0, 3)
    assert s.discarded_pct == 100.0


def test_exact_multiple_and_spanning(spark):
    docs = [(0, list(range(10))), (1, []), (2, [10, 11]), (3, list(range(12, 16)))]
    assert _packed(_df(spark, docs), 4) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11], [12, 13, 14, 15]]
    s = P.pack_stats(_df(spark, docs), 4).first()
    assert s.discarded_tokens == 0 and s.sequences == 4


def test_running_sum_and_row_index(spark):
    rows = [(k, k % 5) for k in random.Random(3).sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k long, v long")
    out, total, nrows = exclusive_running_sum(df, ["k"], "v", "start", n_buckets=7)
    got = {r.k: r.start for r in out.collect()}
    acc = 0
    for k, v in sorted(rows):
        assert got[k] == acc
        acc += v
    assert total == acc and nrows == len(rows)
    idx = {r.k: r.row_index for r in global_row_index(df, ["k"], n_buckets=6).collect()}
    assert [idx[k] for k, _ in sorted(rows)] == list(range(len(rows)))


def test_training_plan_and_clm(spark):
    packed = spark.createDataFrame([(i, [1, 0, 2], [1, 0, 2]) for i in range(17)], P_SCHEMA)
    r = P.training_plan(packed, batch_size=2, grad_accum=4, num_epochs=3, steps_per_second=0.25).first()
    assert (r.steps_per_epoch, r.total_steps, r.total_seconds) == (3, 9, 36.0)
    assert (r.hours, r.minutes, r.seconds) == (0, 0, 36)
    one = spark.createDataFrame([(0, [1], [1])], P_SCHEMA)
    assert P.training_plan(one.where("seq_id < 0"), 2, 4, 1).first().steps_per_epoch == 1
    lab = P.clm_labels(packed, pad_id=0).first().labels
    assert lab == [1, -100, 2]


P_SCHEMA = "seq_id long, input_ids array<int>, labels array<int>"


def test_order_key_must_be_unique(spark):
    import pytest

    from scriptorium.operators import pack as P

    for keys in ((1, 1, 2), (1, None, 2)):
        df = spark.createDataFrame([(k, [1, 2, 3]) for k in keys], "ord long, input_ids array<int>")
        with pytest.raises(ValueError, match="unique"):
            P.pack_sequences(df, 4)


def test_every_row_is_numbered_once(spark):
    from scriptorium.operators.ordering import global_row_index

    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    got = sorted((r.row_index, r.k) for r in global_row_index(df, ["k"]).collect())
    assert got == [(0, None), (1, 1), (2, 1), (3, 2)]
