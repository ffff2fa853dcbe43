"""Outputs that count only when a job has ended, and shards by rank."""

import os
import tempfile

import pytest

from scriptorium import session
from scriptorium.plans import jobs
from scriptorium.sources import sinks
from tests.test_jobs import BOOK, _tree

PARAMS = jobs.CPTParams(max_seq_len=16, tokenizer="codepoints", eval_split=0.25)


def test_a_job_that_ends_early_leaves_nothing_readable(spark, monkeypatch):
    root = _tree({"a.txt": BOOK.format(n="a", body="alpha " * 30).encode()})
    out = tempfile.mkdtemp(prefix="scriptorium-out-")

    def killed(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_split", killed)
        with pytest.raises(KeyboardInterrupt):
            jobs.prepare_cpt(spark, root, out, PARAMS)
    assert os.listdir(out)  # data is there
    with pytest.raises(FileNotFoundError):
        sinks.open_run(spark, out)
    first = jobs.prepare_cpt(spark, root, out, PARAMS)
    manifest, data = sinks.open_run(spark, out)
    assert sinks.read_packed(spark, f"{data}/packed").count() == manifest.sequences == first["plan"]["sequences"]
    # a second run that fails leaves the first one in place
    with monkeypatch.context() as m:
        m.setattr(sinks, "commit_manifest", killed)
        with pytest.raises(KeyboardInterrupt):
            jobs.prepare_cpt(spark, root, out, PARAMS)
    assert sinks.open_run(spark, out)[1] == data


def test_the_manifest_has_the_counts_of_the_run(spark):
    root = _tree({"a.txt": BOOK.format(n="a", body="alpha " * 30).encode(), "b.txt": b"no marker", "c.txt": b"\xff"})
    out = tempfile.mkdtemp(prefix="scriptorium-out-")
    jobs.prepare_cpt(spark, root, out, PARAMS)
    m, _ = sinks.open_run(spark, out)
    chars = len(("alpha " * 30).strip())
    assert (m.books, m.files, m.undecodable, m.clean_chars, m.total_tokens) == (2, 3, 1, chars, chars)
    assert (m.sequences, m.discarded_tokens, m.effective_batch) == (chars // 16, chars % 16, 16)


def test_jobs_release_their_own_folders_alone(spark):
    mine = session.materialize(spark.range(5), "mine")
    root = _tree({"a.txt": BOOK.format(n="a", body="alpha " * 30).encode()})
    before = {p for p in os.listdir(_scratch(spark))}
    jobs.prepare_cpt(spark, root, tempfile.mkdtemp(prefix="scriptorium-out-"), PARAMS)
    assert mine.count() == 5 and {p for p in os.listdir(_scratch(spark))} == before
    with pytest.raises(ZeroDivisionError):
        with session.intermediates(spark):
            session.materialize(spark.range(3), "lost")
            1 / 0
    assert {p for p in os.listdir(_scratch(spark))} == before


def _scratch(spark):
    return f"{session.checkpoint_root(spark)}/{spark.sparkContext.applicationId}"


def test_shards_of_all_ranks_make_up_the_table(spark):
    rows = [(i, [i, i + 1], [i, i + 1]) for i in range(1000)]
    packed = spark.createDataFrame(rows, sinks.PACKED_SCHEMA)
    path = sinks.write_indexed(packed.repartition(5), tempfile.mkdtemp(prefix="scriptorium-shards-") + "/packed", files=10)
    index = spark.read.parquet(f"{path}.index").orderBy("first_seq").collect()
    assert sum(r.sequences for r in index) == 1000 and all(a.last_seq < b.first_seq for a, b in zip(index, index[1:]))
    for world in (1, 3, 25):
        shards = [sinks.read_rank(spark, path, r, world, verify=True) for r in range(world)]
        assert sorted(x.seq_id for s in shards for x in s.collect()) == list(range(1000))
        files = [set(s.inputFiles()) for s in shards]
        assert sum(map(len, files)) == len(set().union(*files)) == len(index)
    with pytest.raises(ValueError):
        sinks.read_rank(spark, path, 3, 3)
    victim = f"{path}/{index[4].file}"
    spark.createDataFrame(rows[:3], sinks.PACKED_SCHEMA).coalesce(1).write.parquet(f"{path}-other")
    (other,) = [f for f in os.listdir(f"{path}-other") if f.endswith(".parquet")]
    with open(f"{path}-other/{other}", "rb") as f, open(victim, "wb") as out:
        out.write(f.read())
    crc = os.path.join(path, f".{index[4].file}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    with pytest.raises(ValueError, match="differ from their index"):
        sinks.read_rank(spark, path, 4, 10, verify=True)


def test_more_ids_make_more_shards(spark, monkeypatch):
    packed = spark.createDataFrame([(i, [i, i + 1], [i, i + 1]) for i in range(1000)], sinks.PACKED_SCHEMA)
    monkeypatch.setattr(sinks, "FILE_IDS", 100)
    path = sinks.write_indexed(packed, tempfile.mkdtemp(prefix="scriptorium-shards-") + "/packed", files=7, n_ids=2000)
    index = spark.read.parquet(f"{path}.index").collect()
    assert len(index) >= 15 and max(r.sequences for r in index) <= 100
    assert sorted(x.seq_id for r in range(4) for x in sinks.read_rank(spark, path, r, 4, verify=True).collect()) == list(range(1000))


def test_books_in_ranges_give_the_same_run(spark):
    import dataclasses

    bodies = {"x/a": "alpha  beta\n\n\n\n" * 30, "b": "beta\n" * 40, "c": "gamma", "y/a": "other\n\nend " * 9, "d": ""}
    root = _tree({f"{k}.txt": BOOK.format(n="n", body=v).encode() for k, v in bodies.items()} | {"bad.txt": b"\xff"})
    runs = []
    for piece in (0, 7, 100):
        out = tempfile.mkdtemp(prefix="scriptorium-out-")
        jobs.prepare_cpt(spark, root, out, dataclasses.replace(PARAMS, piece_bytes=piece))
        m, data = sinks.open_run(spark, out)
        rows = sinks.read_packed(spark, f"{data}/packed").orderBy("seq_id").collect()
        runs.append((rows, {k: m[k] for k in ("books", "files", "undecodable", "raw_chars", "clean_chars", "total_tokens", "sequences")}))
    assert runs[0] == runs[1] == runs[2] and runs[0][1]["books"] == 4
