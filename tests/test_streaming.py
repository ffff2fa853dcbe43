"""The streaming corpus job equals the batch cleaner, incrementally."""

import os
import tempfile

from scriptorium.operators import clean as C
from scriptorium.streaming.corpus_stream import start_corpus_stream

BOOK = "head\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\nBody “one”.\n\n\n\nXII.\nEnd---\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\nlic"


def _write(root, rel, data):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_stream_matches_batch_and_is_incremental(spark):
    src, out, ckpt = (tempfile.mkdtemp(prefix=f"scriptorium-{n}-") for n in ("in", "out", "ckpt"))
    _write(src, "a/one.txt", BOOK.encode())
    _write(src, "a/bad.txt", b"\xff\xfe")
    for q in start_corpus_stream(spark, src, out, ckpt):
        q.awaitTermination()
    got = {r.name: r.clean for r in spark.read.parquet(f"{out}/cleaned").collect()}
    expect = C.clean_corpus(spark.createDataFrame([(0, BOOK)], "doc_id long, text string")).first().clean
    assert got == {"one": expect} and expect == "Body \"one\".\n\nEnd--"
    assert spark.read.parquet(f"{out}/rejected").count() == 1
    # a second file arriving later is processed alone on restart
    _write(src, "b/two.txt", BOOK.replace("Body", "Second").encode())
    for q in start_corpus_stream(spark, src, out, ckpt):
        q.awaitTermination()
    names = sorted(r.name for r in spark.read.parquet(f"{out}/cleaned").collect())
    assert names == ["one", "two"]
    ids = spark.read.parquet(f"{out}/cleaned").where("name = 'one'").first().input_ids
    assert ids == [ord(c) for c in expect]


def test_corpus_stream_source_holds_listings_not_books(spark):
    src, out, ckpt = (tempfile.mkdtemp(prefix=f"scriptorium-many-{n}-") for n in ("in", "out", "ckpt"))
    for i in range(60):
        _write(src, f"d{i % 7}/book-{i}.txt", BOOK.replace("Body", f"Body {i}").encode())
    _write(src, "_hidden/book-x.txt", BOOK.encode())
    for _ in range(2):  # a restart finds nothing new
        for q in start_corpus_stream(spark, src, out, ckpt):
            q.awaitTermination()
    got = spark.read.parquet(f"{out}/cleaned")
    assert sorted(r.name for r in got.collect()) == sorted(f"book-{i}" for i in range(60))
    assert got.first().path.startswith(f"file:{src}/")
    log = "".join(open(os.path.join(d, f), errors="replace").read() for sub in ("cleaned", "rejected")
                  for d, _, names in os.walk(f"{ckpt}/{sub}/sources") for f in names if not f.startswith("."))
    assert "/files/part-" in log and "book-" not in log


def test_sft_stream_routes_rejects_and_is_incremental(spark):
    import json

    from scriptorium.streaming.chat_stream import start_sft_stream

    src, out, ckpt = (tempfile.mkdtemp(prefix=f"scriptorium-sft-{n}-") for n in ("in", "out", "ckpt"))
    ok = json.dumps({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]})
    _write(src, "a.jsonl", (ok + "\n\n" + json.dumps({"messages": []}) + "\n").encode())
    for q in start_sft_stream(spark, src, out, ckpt, max_seq_len=512):
        q.awaitTermination()
    ex = spark.read.parquet(f"{out}/examples").collect()
    assert len(ex) == 1 and ex[0].labels[: ex[0].prompt_len] == [-100] * ex[0].prompt_len
    assert spark.read.parquet(f"{out}/rejected").first().reject_reason == "messages empty"
    _write(src, "b.jsonl", (ok.replace("yo", "hey") + "\n").encode())
    for q in start_sft_stream(spark, src, out, ckpt, max_seq_len=512):
        q.awaitTermination()
    assert spark.read.parquet(f"{out}/examples").count() == 2
