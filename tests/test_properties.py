"""Property tests: generated inputs, one Spark job per example."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.operators import clean as C
from scriptorium.operators import pack as P
from tests.test_pack import brute
from tests.test_text import POOL, model_clean

_docs = st.lists(st.lists(st.integers(0, 50_000), max_size=40), min_size=1, max_size=25)

_line = st.one_of(
    st.sampled_from(POOL),
    st.text(alphabet=st.sampled_from(list("IVX.-{} *=_~+#$%&–—“”‘’٣1aé\t  \u000b")), max_size=8),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(docs=_docs, L=st.integers(1, 33))
def test_packing_equals_brute_force(spark, docs, L):
    rows = [(i * 7, ids) for i, ids in enumerate(docs)]
    expect, total = brute(rows, L)
    df = spark.createDataFrame(rows, "ord long, input_ids array<int>")
    got = [list(r.input_ids) for r in P.pack_sequences(df, L, n_buckets=3).orderBy("seq_id").collect()]
    assert got == expect
    s = P.pack_stats(df, L).first()
    assert s.total_tokens == total and s.kept_tokens + s.discarded_tokens == total


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(docs=st.lists(st.lists(_line, max_size=20).map("\n".join), min_size=1, max_size=30))
def test_cleaner_equals_model(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r.clean for r in C.clean_corpus(df).collect()}
    assert all(got[i] == model_clean(d) for i, d in enumerate(docs))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=400),
       fraction=st.floats(0.0, 0.9), seed=st.integers(0, 1000))
def test_split_equals_brute_force(spark, monkeypatch, keys, fraction, seed):
    import hashlib
    import math

    from scriptorium.operators import split as SP

    monkeypatch.setattr(SP, "SMALL_BUCKET", 3)  # force the multi-level digest search
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k for r in SP.train_eval_split(df, "k", fraction, seed).where("split = 'eval'").collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    assert got == set(order[: math.ceil(fraction * len(keys))])


_content = st.text(st.characters(blacklist_categories=("Cs",)), max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(convs=st.lists(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant"]), _content),
                               min_size=1, max_size=4), min_size=1, max_size=15),
       ascii_only=st.booleans())
def test_jsonl_reader_equals_python_json(spark, convs, ascii_only):
    import json
    import os
    import tempfile

    from scriptorium.sources import jsonl as J

    root = tempfile.mkdtemp(prefix="scriptorium-prop-jsonl-")
    path = os.path.join(root, "x.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        for c in convs:
            f.write(json.dumps({"messages": [{"role": r, "content": t} for r, t in c]}, ensure_ascii=ascii_only))
            f.write("\n")
    rows = J.read_chat_jsonl(spark, path).orderBy("example_id").collect()
    assert [[(m.role, m.content) for m in r.messages] for r in rows] == [list(c) for c in convs]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(convs=st.lists(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant"]),
                                         st.text(alphabet="ab é\n", max_size=12)), min_size=1, max_size=6),
                      min_size=1, max_size=12),
       L=st.integers(1, 120))
def test_turn_level_sft_equals_record_level(spark, convs, L):
    from scriptorium.operators import chat as M

    rows = [(c, t, role, text) for c, conv in enumerate(convs) for t, (role, text) in enumerate(conv)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    a = {r.conv_id: (r.input_ids, r.labels, r.prompt_len) for r in M.sft_examples_from_turns(turns, L).collect()}
    b = {r.conv_id: (r.input_ids, r.labels, r.prompt_len)
         for r in M.sft_examples(M.assemble_messages(turns), L, keep=("conv_id",)).collect()}
    assert a == b


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(n=st.integers(0, 5000), bs=st.integers(1, 8), acc=st.integers(1, 16), ep=st.integers(1, 5),
       ddp=st.booleans())
def test_training_plan_formula(spark, n, bs, acc, ep, ddp):
    import math

    from scriptorium.operators import pack as P

    rate = P.steps_per_second_for(ddp)
    packed = spark.range(n).select(F.col("id").alias("seq_id"))
    r = P.training_plan(packed, bs, acc, ep, rate).first()
    spe = max(1, math.ceil(n / (bs * acc)))
    secs = spe * ep / rate
    m, s = divmod(int(secs), 60)
    h, m = divmod(m, 60)
    assert (r.steps_per_epoch, r.total_steps, r.hours, r.minutes, r.seconds) == (spe, spe * ep, h, m, s)
    assert (r.epoch_hours, r.epoch_minutes) == (h // ep, m // ep) and r.total_seconds == round(secs, 6)
