"""Packing laid out for files: brute force, layout, what it keeps on disk."""

import os
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import tokens as K
from scriptorium.operators import pack as P
from scriptorium.operators import pack_ranges as R
from scriptorium.session import checkpoint_root, intermediates, scratch_path
from scriptorium.sources import sinks


def _docs(seed, n=60):
    rnd = random.Random(seed)
    ids = lambda k: [rnd.randint(-2**31, 2**31 - 1) if rnd.random() < 0.9 else None for _ in range(k)]
    return [(i * 3 + rnd.randint(0, 2) - 50, ids(rnd.choice([0, 1, 3, 20, 130, 900])) if rnd.random() < 0.9 else None) for i in range(n)]


KINDS = {"long": lambda k: k, "string": lambda k: f"é{k + 50:04d}", "binary": lambda k: b"%04d" % (k + 50), "double": lambda k: k / 2}


@pytest.mark.parametrize("L,files,kind", [(1, 7, "long"), (7, 3, "string"), (16, 40, "binary"), (64, 7, "double"), (5, 1, "long"), (3000, 9, "long")])
def test_ranges_match_brute_force(spark, L, files, kind):
    docs = [(KINDS[kind](k), ids) for k, ids in _docs(L)]
    df = spark.createDataFrame(docs, f"ord {kind}, input_ids array<int>").repartition(5)
    asked = []
    packed, n = P.pack_counted(df, L, ranges=lambda n_ids: asked.append(n_ids) or files)
    stream = [x for _, ids in sorted(docs, key=lambda d: d[0]) for x in ids or []]
    rows = packed.withColumn("part", F.spark_partition_id()).collect()
    assert n == len(stream) // L and set(asked) == {n * L}
    # partitions one after the other hold the sequences in order
    assert [r.seq_id for r in rows] == list(range(n))
    assert [r.input_ids for r in rows] == [stream[i * L:(i + 1) * L] for i in range(n)] == [r.labels for r in rows]
    if kind != "double":  # ranged by a sample of the rows
        share = [sum(r.part == p for r in rows) for p in range(min(files, n))]
        assert sum(share) == n and max(share) - min(share) <= 1


def test_ranges_of_nothing_and_of_bad_keys(spark):
    short = spark.createDataFrame([(0, [1, 2]), (1, None)], "ord long, input_ids array<int>")
    packed, n = P.pack_counted(short, 8, ranges=lambda n_ids: 3)
    assert n == 0 and packed.count() == 0
    for keys in ((1, 1, 2), (1, None, 2)):
        with pytest.raises(ValueError, match="unique"):
            P.pack_counted(spark.createDataFrame([(k, [1, 2, 3]) for k in keys], "ord long, input_ids array<int>"), 2, ranges=lambda n_ids: 3)


def test_bytes_of_ids_and_back():
    codec = pa.Codec("zstd")
    for ids in ([], [0], [None], [1, None, -1], [2**31 - 1, -2**31, 255, 256] * 50):
        held = pa.array([9, *ids], pa.int32()).slice(1)
        assert R.bytes_ids(R.ids_bytes(held, codec), codec).to_pylist() == ids


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def _texts(spark, parts=4):
    """A folder with ``documents.parquet`` of words as frequent as in prose, and its bytes."""
    rnd = random.Random(7)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", range(26, 0, -1), k=rnd.randint(2, 9))) for _ in range(4000)]
    texts = [(i, " ".join(rnd.choices(words, [1 / k for k in range(1, 4001)], k=600))) for i in range(500)]
    root = tempfile.mkdtemp(prefix="scriptorium-ranges-")
    spark.createDataFrame(texts, "doc_id long, text string").repartition(parts).write.parquet(f"{root}/documents.parquet")
    return root, _size(f"{root}/documents.parquet")


def _kept(spark):
    mine = f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}"
    return {f"{mine}/{x}" for x in os.listdir(mine)} if os.path.isdir(mine) else set()


def test_packed_ranks_keeps_its_shards_alone(spark):
    from scriptorium.plans.token_queries import pack_sequences, packed_ranks

    root, given = _texts(spark)
    before = _kept(spark)
    ranks = packed_ranks(spark, root)
    kept = _kept(spark) - before
    assert sum(map(_size, kept)) < 3 * given
    assert sorted(map(tuple, ranks.collect())) == sorted(map(tuple, pack_sequences(spark, root).collect()))
    assert len(kept) == 2 and any(f.endswith(".index") for f in kept)


def test_ids_are_stored_small_and_shuffled_once(spark):
    root, given = _texts(spark)
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", K.codepoint_ids(F.col("text")).alias("input_ids"))
    before, path = _kept(spark), scratch_path(spark, "ranged-shards")
    with intermediates(spark):
        packed, n = P.pack_counted(docs, 2048, "doc_id", ranges=lambda n_ids: 7)
        (held,) = [_size(f) for f in _kept(spark) - before if "/tokens-" in f]
        plan = packed._jdf.queryExecution().executedPlan().toString()
        sinks.write_indexed(packed, path, ranged=True)
    # the tokens, the one shuffle of their bytes (as large) and the shards stand beside one another
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert 2 * held + _size(path) < 4 * given
    index = spark.read.parquet(f"{path}.index").orderBy("first_seq").collect()
    assert len(index) == 7 and all(a.last_seq + 1 == b.first_seq for a, b in zip(index, index[1:]))
    assert (index[0].first_seq, index[-1].last_seq) == (0, n - 1)


def test_a_reader_holds_few_rows_of_a_shard(spark):
    import pyarrow.parquet as pq

    packed = spark.range(0, 3000, 1, 1).select(F.col("id").alias("seq_id"), F.sequence(F.lit(1), F.lit(2048)).alias("input_ids"))
    path = sinks.write_indexed(packed.withColumn("labels", F.col("input_ids")), scratch_path(spark, "groups"), files=1, ranged=True)
    (file,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    meta = pq.ParquetFile(f"{path}/{file}").metadata
    assert meta.num_rows == 3000 and max(meta.row_group(g).num_rows for g in range(meta.num_row_groups)) <= sinks.GROUP_ROWS


def test_file_count():
    assert sinks.file_count(7, 0) == sinks.file_count(7, 7 * sinks.FILE_IDS) == 7
    assert sinks.file_count(7, 7 * sinks.FILE_IDS + 1) == 8
