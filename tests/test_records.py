"""Records, batches, previews and examples from slim keys."""

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import tokens as K
from scriptorium.operators import batches as B
from scriptorium.operators import chat as M
from scriptorium.operators import dictionary_tokens as D
from scriptorium.operators import pack as P
from scriptorium.sources import corpus as CO
from scriptorium.sources import jsonl as J
from tests.test_plans import plan

TURNS = "conv_id long, turn int, role string, text string"


def big_plan(spark, make):
    """The plan of a frame made while nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(spark, make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges_with(text, column):
    """Shuffles whose rows carry ``column``."""
    return len(re.findall(rf"\) Exchange\nInput \[\d+\]: \[[^\]]*\b{column}#", text))


def test_streamed_records_of_a_hot_conversation(spark):
    """One conversation holds most rows and spans many Arrow batches."""
    rows = [(7, t, "user" if t % 2 else "assistant", f"text {t}") for t in range(30_000)]
    rows += [(c, t, "user", f"{c}:{t}") for c in (None, -3, 6, 8, 9) for t in range(c or 4 if (c or 4) > 0 else 1)]
    rows += [(10, 1, "user", None), (10, 0, None, "x"), (11, None, "user", "first")]
    got = M.assemble_messages(spark.createDataFrame(rows, TURNS).repartition(5))
    assert "collect_list" not in plan(spark, got)
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        want.setdefault(c, []).append((role, text))
    assert {r.conv_id: [tuple(m) for m in r.messages] for r in got.collect()} == want
    assert M.assemble_messages(spark.createDataFrame([], TURNS)).count() == 0


def test_null_content_rejects_the_conversation(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 2, "user", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, None, "x")]
    turns = spark.createDataFrame(rows, TURNS)
    a = M.sft_examples(M.assemble_messages(turns), 64, keep=("conv_id",))
    b = M.sft_examples_from_turns(turns, 64)
    assert [r.conv_id for r in a.collect()] == [r.conv_id for r in b.collect()] == [2]
    assert a.first().labels == b.first().labels
    _, rejects = M.split_rejects(M.assemble_messages(turns))
    assert sorted(r.conv_id for r in rejects.collect()) == [1, 3]


def test_jsonl_is_numbered_where_it_is_read(spark):
    root = tempfile.mkdtemp(prefix="scriptorium-jsonl-")
    n = 0
    for f in ("b.jsonl", "a.jsonl", "c.jsonl"):
        with open(f"{root}/{f}", "w") as out:
            for i in range(400 if f != "a.jsonl" else 3):
                out.write(json.dumps({"messages": [{"role": "user", "content": f"{f} {i:04d} " + "x" * 200}]}) + "\n" * (1 + i % 3))
                n += 1
        os.makedirs(f"{root}/empty", exist_ok=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # files in many blocks, blocks in one partition
    try:
        got = J.read_chat_jsonl(spark, f"{root}/*.jsonl")
        rows = {r.example_id: r.messages[0].content for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(rows) == list(range(n)) and [rows[i] for i in range(n)] == sorted(rows.values())
    assert exchanges_with(plan(spark, got), "messages") == 0


def test_preview_reads_only_what_overlaps(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens = d.select(F.col("doc_id").alias("ord"), K.codepoint_ids(F.col("text")).alias("input_ids"))
    for length in (50, 777, 100_000):
        for seed in (1, 42):
            want = P.preview_chunk(P.pack_sequences(tokens, length), K.codepoint_text, seed).first()
            assert P.preview_window(tokens, K.codepoint_text, length, seed).first() == want
    none = P.preview_window(tokens, K.codepoint_text, 10 ** 9)
    assert none.count() == 0
    text = plan(spark, P.preview_window(tokens, K.codepoint_text, 777))
    assert "hashpartitioning(seq_id" not in text and "Generate" not in text
    plain = P.plan_of_count(P.pack_stats(tokens, 777)).first()
    assert plain == P.training_plan(P.pack_sequences(tokens, 777)).first()


def test_batches_move_the_payload_once(spark):
    rows = [(i, list(range(1 + i % 9))) for i in range(50)]
    df = spark.createDataFrame(rows, "example_id long, input_ids array<int>").withColumn("attention_mask", F.col("input_ids")).withColumn(
        "labels", F.col("input_ids"))
    text = big_plan(spark, lambda: B.collate_pad(B.assign_batches(df, ["example_id"], 4, 2), 0))
    assert exchanges_with(text, "input_ids") == 1 and "Window" not in text
    with pytest.raises(ValueError):
        B.assign_batches(df.unionByName(df.limit(1)), ["example_id"])
    with pytest.raises(ValueError):
        B.assign_batches(df.withColumn("example_id", F.lit(None).cast("long")), ["example_id"])
    assert (B.effective_batch(2, 2, 4), B.effective_batch(2, 2, 4, use_ddp=False)) == (16, 8)


def test_names_are_settled_without_texts(spark):
    root = tempfile.mkdtemp(prefix="scriptorium-names-")
    for d in "abc":
        os.makedirs(f"{root}/{d}")
        for n in range(5):
            with open(f"{root}/{d}/{n if d != 'c' else 'x'}.txt", "w") as f:
                f.write(f"{d}{n}")
    make = lambda: CO.load_books(spark, root)[0]
    text = big_plan(spark, make)
    assert exchanges_with(text, "text") == 1 and "max_by" not in text and "SortAggregate" not in text
    assert exchanges_with(plan(spark, make()), "text") == 0


def test_a_tokenizer_is_shipped_and_checked(spark):
    spec = K.bpe_spec(spark=spark)
    assert spec.effective_pad_id == spec.eos_id == 50256 and len(spec.sha256) == 64
    df = spark.createDataFrame([("a b<|endoftext|>c",)], "text string").select(K.bpe_encoder(spec)(F.col("text")).alias("input_ids"))
    r = P.clm_labels(df, spec.effective_pad_id).first()
    assert spec.eos_id in r.input_ids and r.labels == [-100 if x == spec.eos_id else x for x in r.input_ids]
    wrong = K.TokenizerSpec("0" * 64, 1)
    with open(os.path.join(tempfile.mkdtemp(), wrong.file_name), "w") as f:
        f.write("{}")
    spark.sparkContext.addFile(f.name)
    with pytest.raises(Exception, match="not the tokenizer that was shipped"):
        df.sparkSession.createDataFrame([("a",)], "text string").select(K.bpe_encoder(wrong)(F.col("text"))).collect()


def test_dictionary_tokens_equal_those_of_whole_texts(spark):
    texts = ["it's  a\n\n test\t  of 12345 wörds—'LL", " ", "日本 語", "x" * 3000, "a  \n", "tab\t\tend  ", "é́ ½ ²"]
    rows = [(i, [("user", t), ("assistant", texts[-1 - i])]) for i, t in enumerate(texts)]
    rows += [(90, []), (91, [("user", None)])]
    df = spark.createDataFrame(rows, "conv_id long, messages array<struct<role:string,content:string>>")
    spec = K.bpe_spec(spark=spark)
    for length in (20, 2048):
        a = M.sft_examples(df, length, spec, keep=("conv_id",)).collect()
        b = D.sft_examples_dictionary(df, "conv_id", D.bpe_ids(spec), D.BYTE_BPE_PATTERN, length).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == len(texts)


def test_dictionary_joins_each_different_token_of_a_text_once(spark, monkeypatch):
    seen = {}

    def materialize(df, name):
        seen[name] = D_materialize(df, name)
        return seen[name]

    D_materialize = D.materialize
    monkeypatch.setattr(D, "materialize", materialize)
    rows = [(i, [("user", "the " * 3000), ("assistant", f"of {i}")]) for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, messages array<struct<role:string,content:string>>")
    words = D.word_ids(["the", "of"])
    got = D.sft_examples_dictionary(df, "conv_id", words, "[A-Za-z]+|[0-9]|[^A-Za-z0-9]", 100_000).collect()
    assert len(got) == 3 and all(len(r.input_ids) > 6000 and r.prompt_len > 6000 for r in got)
    assert seen["token-pairs"].count() < 100
