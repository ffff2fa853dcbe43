"""Chat assembly, system injection, rendering, masking, split, batches."""

import math

from pyspark.sql import functions as F

from scriptorium.functions import chat as CH
from scriptorium.operators import batches as B
from scriptorium.operators import chat as M
from scriptorium.operators import split as SP

MSG = "conv_id long, messages array<struct<role:string,content:string>>"


def _msgs(spark, rows):
    return spark.createDataFrame(rows, MSG)


def test_assemble_orders_turns(spark):
    turns = spark.createDataFrame([(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b")],
                                  "conv_id long, turn long, role string, text string")
    m = M.assemble_messages(turns).first().messages
    assert [(x.role, x.content) for x in m] == [("user", "a"), ("assistant", "b"), ("user", "c")]


def test_system_injected_only_when_absent_anywhere(spark):
    df = _msgs(spark, [(0, [("user", "u"), ("assistant", "a")]),
                       (1, [("user", "u"), ("system", "s"), ("assistant", "a")])])
    out = {r.conv_id: [(m.role, m.content) for m in r.messages] for r in M.ensure_system(df, "SYS").collect()}
    assert out[0][0] == ("system", "SYS") and len(out[0]) == 3
    assert out[1] == [("user", "u"), ("system", "s"), ("assistant", "a")]


def test_render_and_mask_length_based(spark):
    df = _msgs(spark, [(0, [("system", "S"), ("user", "hi"), ("assistant", "yo")])])
    r = M.render_texts(df).first()
    assert r.full_text == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n" \
                          "<|im_start|>assistant\nyo<|im_end|>\n"
    assert r.prompt_text == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n" \
                            "<|im_start|>assistant\n"
    e = M.sft_examples(df, 10_000).first()
    plen = len(r.prompt_text)
    assert e.prompt_len == plen
    assert e.labels[:plen] == [-100] * plen and e.labels[plen:] == e.input_ids[plen:]
    assert e.attention_mask == [1] * len(e.input_ids)


def test_last_message_is_target_whatever_role(spark):
    df = _msgs(spark, [(0, [("system", "S"), ("assistant", "a"), ("user", "last")])])
    e = M.sft_examples(df, 10_000).first()
    masked = sum(1 for x in e.labels if x == -100)
    assert masked == e.prompt_len


def test_prompt_longer_than_limit_fully_masked(spark):
    df = _msgs(spark, [(0, [("system", "S" * 50), ("user", "u" * 50), ("assistant", "a")])])
    e = M.sft_examples(df, 20).first()
    assert len(e.input_ids) == 20 and e.labels == [-100] * 20


def test_rejects(spark):
    df = spark.createDataFrame([(0, []), (1, [("user", None)]), (2, [("user", "ok")]), (3, None)], MSG)
    good, bad = M.split_rejects(df)
    assert [r.conv_id for r in good.collect()] == [2]
    assert sorted(r.conv_id for r in bad.collect()) == [0, 1, 3]


def test_inference_prompt(spark):
    df = spark.createDataFrame([("",), ("q",)], "prompt string")
    out = [r.prompt_text for r in M.inference_prompts(df, "prompt", "Be brief.").collect()]
    assert out[0] == "<|im_start|>system\nBe brief.<|im_end|>\n<|im_start|>user\nhello<|im_end|>\n" \
                     "<|im_start|>assistant\n"
    out2 = [r.prompt_text for r in M.inference_prompts(df, "prompt").collect()]
    assert out2[1] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"


def test_completion_slice(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], 2), ([1], 5)], "ids array<int>, p int")
    got = [r[0] for r in df.select(M.completion_slice(F.col("ids"), F.col("p"))).collect()]
    assert got == [[3, 4], []]


def test_split_exact_disjoint_complete(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "k")
    s = SP.train_eval_split(df, "k", 0.05, 42)
    ev = {r.k for r in s.where("split = 'eval'").collect()}
    assert len(ev) == math.ceil(0.05 * 1000)
    assert s.count() == 1000
    import hashlib
    expect = sorted(range(1, 1001), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))[:50]
    assert ev == set(expect)
    assert SP.train_eval_split(df, "k", 0.0).where("split = 'eval'").count() == 0


def test_split_multi_level_search(spark, monkeypatch):
    monkeypatch.setattr(SP, "SMALL_BUCKET", 1)
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    ev = {r.k for r in SP.train_eval_split(df, "k", 0.1, 7).where("split = 'eval'").collect()}
    import hashlib
    expect = sorted(range(3000), key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k))[:300]
    assert ev == set(expect)


def test_batches_and_padding(spark):
    rows = [(i, [7] * (i + 1), [1] * (i + 1), [5] * (i + 1)) for i in range(5)]
    df = spark.createDataFrame(rows, "example_id long, input_ids array<int>, attention_mask array<int>, labels array<int>")
    b = B.assign_batches(df, ["example_id"], batch_size=2, grad_accum=2, n_buckets=3)
    got = {r.example_id: (r.batch_id, r.step_id) for r in b.collect()}
    assert got == {0: (0, 0), 1: (0, 0), 2: (1, 0), 3: (1, 0), 4: (2, 1)}
    p = {r.example_id: r for r in B.collate_pad(b, pad_id=0).collect()}
    assert p[0].input_ids == [7, 0] and p[0].attention_mask == [1, 0] and p[0].labels == [5, -100]
    assert len(p[4].input_ids) == 5 and B.effective_batch(2, 2, 4) == 16


def test_template_is_parameter():
    t = CH.ChatTemplate(prefix="[", role_sep=":", suffix="]\n", assistant_role="bot")
    assert t.generation_header == "[bot:"


def test_turn_level_builder_equals_record_level_with_hot_conversation(spark):
    rows = [(0, i, "user" if i % 2 == 0 else "assistant", f"m{i} " * (i % 5)) for i in range(300)]
    rows += [(1, 0, "system", "S"), (1, 1, "user", "hi"), (2, 0, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for L in (7, 64, 100_000):
        a = {r.conv_id: r for r in M.sft_examples_from_turns(turns, L).collect()}
        b = {r.conv_id: r for r in M.sft_examples(M.assemble_messages(turns), L, keep=("conv_id",)).collect()}
        assert a.keys() == b.keys() == {0, 1, 2}
        for k in a:
            assert (a[k].input_ids, a[k].labels, a[k].attention_mask, a[k].prompt_len) == \
                   (b[k].input_ids, b[k].labels, b[k].attention_mask, b[k].prompt_len)


def test_require_assistant_last_option(spark):
    df = _msgs(spark, [(0, [("user", "u"), ("assistant", "a")]), (1, [("assistant", "a"), ("user", "u")])])
    good, bad = M.split_rejects(df)
    assert good.count() == 2 and bad.count() == 0
    good, bad = M.split_rejects(df, require_assistant_last=True)
    assert [r.conv_id for r in good.collect()] == [0]
    assert [r.reject_reason for r in bad.collect()] == ["last message not assistant"]


def test_length_sorted_batches_reduce_padding(spark):
    import random
    rnd = random.Random(1)
    rows = [(i, [1] * rnd.randint(1, 50)) for i in range(64)]
    df = spark.createDataFrame(rows, "example_id long, input_ids array<int>").withColumn(
        "attention_mask", F.transform("input_ids", lambda x: F.lit(1))).withColumn("labels", F.col("input_ids"))

    def padded_total(b):
        return sum(len(r.input_ids) for r in B.collate_pad(b, pad_id=0).collect())

    plain = B.assign_batches(df, ["example_id"], batch_size=4, grad_accum=1)
    sorted_ = B.assign_batches(df, ["example_id"], batch_size=4, grad_accum=1, by_length="input_ids")
    assert sorted_.count() == 64 and sorted(r.row_index for r in sorted_.collect()) == list(range(64))
    assert padded_total(sorted_) < padded_total(plain)
