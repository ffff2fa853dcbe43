"""Byte-level BPE through the Arrow UDF: id range, lossless round trip,
partition independence."""

from pyspark.sql import functions as F

from scriptorium.functions import tokens as K
from scriptorium.operators import chat as M

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_bpe_round_trip_and_partitions(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "text")
    enc, dec = K.bpe_encoder(), K.bpe_decoder()
    t = d.select("doc_id", "text", enc(F.col("text")).alias("ids"))
    rows = t.select("doc_id", "text", dec(F.col("ids")).alias("back"), F.size("ids").alias("n"),
                    F.array_min("ids").alias("lo"), F.array_max("ids").alias("hi")).collect()
    assert all(r.back == r.text for r in rows)
    assert all(r.lo >= 0 and r.hi < 50257 for r in rows if r.n > 0)
    total_one = d.coalesce(1).select(F.sum(F.size(enc(F.col("text"))))).first()[0]
    total_many = d.repartition(7).select(F.sum(F.size(enc(F.col("text"))))).first()[0]
    assert total_one == total_many == sum(r.n for r in rows)


def test_bpe_spec_pad_falls_back_to_eos():
    spec = K.bpe_spec()
    assert spec.eos_id == 50256 and spec.pad_id is None and spec.effective_pad_id == 50256


def test_sft_bpe_mask(spark):
    df = spark.createDataFrame([(0, [("system", "S"), ("user", "hello there"), ("assistant", "general kenobi")])],
                               "conv_id long, messages array<struct<role:string,content:string>>")
    e = M.sft_examples(df, 1024, tokenizer=K.default_tokenizer_file()).first()
    assert e.prompt_len > 0 and e.labels[:e.prompt_len] == [-100] * e.prompt_len
    assert e.labels[e.prompt_len:] == e.input_ids[e.prompt_len:]


def test_bpe_packing_equals_python_brute_force(spark):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from scriptorium.operators import pack as P

    L = 512
    t = pq.read_table(DOCS, columns=["doc_id", "text"]).to_pylist()
    tok = Tokenizer.from_file(K.default_tokenizer_file())
    stream = []
    for row in sorted(t, key=lambda r: r["doc_id"]):
        stream += tok.encode(row["text"], add_special_tokens=False).ids
    n = len(stream) // L
    d = spark.read.parquet(DOCS)
    toks = d.select(F.col("doc_id").alias("ord"), K.bpe_encoder()(F.col("text")).alias("input_ids"))
    got = [list(r.input_ids) for r in P.pack_sequences(toks, L, n_buckets=4).orderBy("seq_id").collect()]
    assert len(got) == n and all(len(g) == L for g in got)
    assert [x for g in got for x in g] == stream[: n * L]


def test_codepoint_round_trip_edges(spark):
    texts = ["aé𝄞\n", "", None, "\u0000x "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ids = K.codepoint_ids(F.col("t"))
    rows = df.select(ids.alias("i"), K.codepoint_text(ids).alias("a"), K.codepoint_text_expr(ids).alias("j")).collect()
    assert [r.a for r in rows] == texts
    assert [r.j for r in rows if r.i is not None] == [t for t in texts if t is not None]
    assert rows[0].i == [97, 233, 119070, 10] and rows[2].i is None


def test_long_batches_are_taken_in_slices():
    import pyarrow as pa

    texts = pa.array(["a b " * 500, None, "", "\u00e9\U0001f600" * 50_000, "b"] * 200)
    parts = list(K._slices(texts))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or sum(len((x or "").encode()) for x in p.to_pylist()) <= K.SLICE for p in parts)
    ids = list(K._codepoints_arrow.func(iter([texts])))
    assert len(ids) == len(parts) and max(len(x.values) for x in ids) <= K.SLICE
    whole = pa.concat_arrays(ids)
    back = list(K._codepoint_text_arrow.func(iter([whole])))
    assert len(back) > 10 and pa.concat_arrays(back).equals(texts)
    assert [list(map(ord, x)) if x is not None else None for x in texts.to_pylist()] == whole.to_pylist()


def test_bpe_encodes_and_decodes_slices(spark, monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    spec = K.bpe_spec(spark=spark)
    tok = Tokenizer.from_file(K.default_tokenizer_file())
    sizes = []

    class Seen:
        def encode_batch(self, texts, **kw):
            sizes.append(sum(map(len, texts)))
            return tok.encode_batch(texts, **kw)

        def decode_batch(self, ids, **kw):
            sizes.append(sum(map(len, ids)))
            return tok.decode_batch(ids, **kw)

    monkeypatch.setattr(K, "_load", lambda _: Seen())
    texts = [f"word {i} " * 2000 if i % 9 else None for i in range(100)]
    ids = pa.concat_arrays(list(K.bpe_encoder(spec).func(iter([pa.array(texts)]))))
    assert ids.to_pylist() == [x and tok.encode(x, add_special_tokens=False).ids for x in texts]
    pairs = pa.concat_arrays(list(K.bpe_pair_encoder(spec).func(iter([(pa.array(texts), pa.array(texts[::-1]))]))))
    assert pairs.field("b").to_pylist() == [x or [] for x in ids.to_pylist()[::-1]]
    text = pa.concat_arrays(list(K.bpe_decoder(spec, False).func(iter([ids]))))
    assert text.to_pylist() == [x or "" for x in texts]
    assert max(sizes) <= K.SLICE and len(sizes) > 10
