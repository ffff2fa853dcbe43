"""Tokenising and packing queries (code points for the oracle, BPE rows-only)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from scriptorium.functions import tokens as K
from scriptorium.operators import clean as C
from scriptorium.operators import pack as P
from scriptorium.plans import fixtures
from scriptorium.plans import oracle as O
from scriptorium.plans.registry import query
from scriptorium.session import intermediates, scratch_path
from scriptorium.sources import sinks
from scriptorium.sources.tables import table

SEQ_LEN = 2048
# the code-point tokenizer has no pad token, so its eos pads, and is masked in packed text
PAD_ID = K.CODEPOINTS.effective_pad_id


def ids_md5(c):
    return F.md5(F.array_join(c.cast("array<string>"), ","))


def _doc_tokens(spark, data_dir):
    d = table(spark, data_dir, "documents")
    return d.select(F.col("doc_id").alias("ord"), K.codepoint_ids(F.col("text")).alias("input_ids"))


def _packed_out(packed):
    return packed.select(
        F.col("seq_id").cast("bigint").alias("seq_id"),
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        ids_md5(F.col("input_ids")).alias("ids_md5"),
        ids_md5(F.col("labels")).alias("labels_md5"),
    )


_CP = "list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c))"


def pack_sql(src_cte: str, L: int = SEQ_LEN) -> str:
    """DuckDB packing by brute force: number every token globally."""
    return f"""
WITH {src_cte},
cp AS (SELECT ord, {_CP} AS ids FROM src),
flat AS (SELECT ord, unnest(ids) AS tok, unnest(generate_series(1, len(ids))) AS pos FROM cp),
g AS (SELECT tok, row_number() OVER (ORDER BY ord, pos) - 1 AS gpos FROM flat),
lim AS (SELECT (count(*) // {L}) * {L} AS kept FROM g),
seqs AS (SELECT gpos // {L} AS seq_id, list(tok ORDER BY gpos) AS ids FROM g, lim WHERE gpos < kept GROUP BY 1)
"""


_DOC_SRC = "src AS (SELECT doc_id AS ord, text FROM documents)"
_PACKED_SELECT = ("SELECT seq_id::BIGINT AS seq_id, len(ids)::BIGINT AS n_tokens, "
                  "md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(ids, ',')) AS labels_md5 FROM seqs")


@query("tokenize_codepoints", f"""
SELECT doc_id, len({_CP})::BIGINT AS n_tokens, md5(array_to_string({_CP}, ',')) AS ids_md5 FROM documents
""")
def tokenize_codepoints(spark, data_dir):
    t = _doc_tokens(spark, data_dir)
    return t.select(F.col("ord").alias("doc_id"), F.size("input_ids").cast("bigint").alias("n_tokens"),
                    ids_md5(F.col("input_ids")).alias("ids_md5"))


@query("tokenize_bpe")
def tokenize_bpe(spark, data_dir):
    d = table(spark, data_dir, "documents")
    enc = K.bpe_encoder()
    t = d.select("doc_id", enc(F.col("text")).alias("ids"))
    return t.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_md5(F.col("ids")).alias("ids_md5"))


@query("decode_tokens", f"""
SELECT doc_id, md5(array_to_string(list_transform({_CP}, lambda x: chr(x)), '')) AS decoded_md5,
       length(array_to_string(list_transform({_CP}, lambda x: chr(x)), ''))::BIGINT AS decoded_chars
FROM documents
""")
def decode_tokens(spark, data_dir):
    t = _doc_tokens(spark, data_dir)
    dec = K.codepoint_text(F.col("input_ids"))
    return t.select(F.col("ord").alias("doc_id"), F.md5(dec).alias("decoded_md5"),
                    F.length(dec).cast("bigint").alias("decoded_chars"))


@query("token_offsets", """
SELECT doc_id, length(text)::BIGINT AS n,
       (sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        - length(text))::BIGINT AS start
FROM documents
""")
def token_offsets(spark, data_dir):
    offsets, _, _ = P.token_offsets(_doc_tokens(spark, data_dir))
    return offsets.select(F.col("ord").alias("doc_id"), "n", "start")


@query("pack_sequences", pack_sql(_DOC_SRC) + _PACKED_SELECT)
def pack_sequences(spark, data_dir):
    return _packed_out(P.pack_sequences(_doc_tokens(spark, data_dir), SEQ_LEN))


@query("pack_stats", f"""
WITH t AS (SELECT sum(length(text))::BIGINT AS total_tokens FROM documents)
SELECT total_tokens, (total_tokens // {SEQ_LEN})::BIGINT AS sequences,
       ((total_tokens // {SEQ_LEN}) * {SEQ_LEN})::BIGINT AS kept_tokens,
       (total_tokens - (total_tokens // {SEQ_LEN}) * {SEQ_LEN})::BIGINT AS discarded_tokens,
       round((total_tokens - (total_tokens // {SEQ_LEN}) * {SEQ_LEN}) / greatest(1, total_tokens) * 100, 6)
         AS discarded_pct
FROM t
""")
def pack_stats(spark, data_dir):
    return P.pack_stats(_doc_tokens(spark, data_dir), SEQ_LEN)


@query("packed_stats", pack_sql(_DOC_SRC) + """
SELECT count(*)::BIGINT AS sequences, (count(*) * coalesce(max(len(ids)), 0))::BIGINT AS tokens,
       (SELECT array_to_string(list_transform(ids[1:8], lambda x: chr(x)), '') FROM seqs WHERE seq_id = 0)
         AS sample_text
FROM seqs
""")
def packed_stats(spark, data_dir):
    packed = P.pack_sequences(_doc_tokens(spark, data_dir), SEQ_LEN)
    return P.packed_stats(packed, K.codepoint_text)


@query("preview_chunk", pack_sql(_DOC_SRC) + """
SELECT seq_id::BIGINT AS seq_id, md5(array_to_string(list_transform(ids, lambda x: chr(x)), '')) AS text_md5
FROM seqs ORDER BY md5('42:' || seq_id::VARCHAR), seq_id LIMIT 1
""")
def preview_chunk(spark, data_dir):
    p = P.preview_window(_doc_tokens(spark, data_dir), K.codepoint_text, SEQ_LEN, seed=42)
    return p.select(F.col("seq_id").cast("bigint").alias("seq_id"), F.md5("text").alias("text_md5"))


@query("training_plan", pack_sql(_DOC_SRC) + """,
n AS (SELECT count(*)::BIGINT AS sequences FROM seqs),
p AS (SELECT sequences, greatest(1, ceil(sequences / 8))::BIGINT AS spe FROM n)
SELECT sequences, 8::BIGINT AS effective_batch, spe AS steps_per_epoch, (spe * 3)::BIGINT AS total_steps,
       round(spe * 3 / 0.25, 6) AS total_seconds,
       (floor(spe * 3 / 0.25)::BIGINT // 3600)::BIGINT AS hours,
       ((floor(spe * 3 / 0.25)::BIGINT % 3600) // 60)::BIGINT AS minutes,
       (floor(spe * 3 / 0.25)::BIGINT % 60)::BIGINT AS seconds,
       ((floor(spe * 3 / 0.25)::BIGINT // 3600) // 3)::BIGINT AS epoch_hours,
       (((floor(spe * 3 / 0.25)::BIGINT % 3600) // 60) // 3)::BIGINT AS epoch_minutes
FROM p
""")
def training_plan(spark, data_dir):
    stats = P.pack_stats(_doc_tokens(spark, data_dir), SEQ_LEN)
    return P.plan_of_count(stats, batch_size=2, grad_accum=4, num_epochs=3, steps_per_second=0.25)


@query("clm_labels", pack_sql(_DOC_SRC) + f"""
SELECT seq_id::BIGINT AS seq_id, len(list_filter(ids, lambda x: x = {PAD_ID}))::BIGINT AS n_masked,
       md5(array_to_string(list_transform(ids, lambda x: CASE WHEN x = {PAD_ID} THEN -100 ELSE x END), ','))
         AS labels_md5
FROM seqs
""")
def clm_labels(spark, data_dir):
    packed = P.clm_labels(P.pack_sequences(_doc_tokens(spark, data_dir), SEQ_LEN), PAD_ID)
    return packed.select(
        F.col("seq_id").cast("bigint").alias("seq_id"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("bigint").alias("n_masked"),
        ids_md5(F.col("labels")).alias("labels_md5"),
    )


def _cleaned_tokens(spark, data_dir):
    d = fixtures.framed_documents(table(spark, data_dir, "documents"))
    c = C.clean_corpus(d)
    return c.select(F.col("doc_id").alias("ord"), K.codepoint_ids(F.col("clean")).alias("input_ids"))


_CLEAN_SRC = f"{O.cleaned_ctes()}, src AS (SELECT doc_id AS ord, clean AS text FROM cleaned)"


@query("cpt_packed_corpus", pack_sql(_CLEAN_SRC) + _PACKED_SELECT)
def cpt_packed_corpus(spark, data_dir):
    """Framed books -> cleaner -> code points -> packed sequences."""
    return _packed_out(P.pack_sequences(_cleaned_tokens(spark, data_dir), SEQ_LEN))


@query("cpt_packed_bpe")
def cpt_packed_bpe(spark, data_dir):
    """Framed books -> cleaner -> byte BPE (materialised once) -> packed sequences."""
    d = fixtures.framed_documents(table(spark, data_dir, "documents"))
    c = C.clean_corpus(d)
    enc = K.bpe_encoder()
    toks = c.select(F.col("doc_id").alias("ord"), enc(F.col("clean")).alias("input_ids"))
    return _packed_out(P.pack_sequences(toks, SEQ_LEN))


@query("packed_roundtrip", pack_sql(_DOC_SRC) + _PACKED_SELECT)
def packed_roundtrip(spark, data_dir):
    packed = P.pack_sequences(_doc_tokens(spark, data_dir), SEQ_LEN)
    back = sinks.read_packed(spark, sinks.write_packed(packed))
    return _packed_out(back)


@query("packed_ranks", pack_sql(_DOC_SRC) + _PACKED_SELECT)
def packed_ranks(spark, data_dir):
    """The shards of four trainers, each read through the index and checked
    against it, make up the packed table."""
    path = scratch_path(spark, "packed-indexed")
    with intermediates(spark):  # the tokens go when the shards are written
        packed, _ = P.pack_counted(_doc_tokens(spark, data_dir), SEQ_LEN, ranges=functools.partial(sinks.file_count, 7))
        sinks.write_indexed(packed, path, ranged=True)
    ranks = [sinks.read_rank(spark, path, r, 4, verify=True) for r in range(4)]
    return _packed_out(functools.reduce(lambda a, b: a.unionByName(b), ranks))


@query("bpe_roundtrip", """
SELECT doc_id, md5(text) AS decoded_md5, length(text)::BIGINT AS decoded_chars FROM documents
""")
def bpe_roundtrip(spark, data_dir):
    """Byte-level BPE is lossless: decoding the encoded ids gives the text back."""
    d = table(spark, data_dir, "documents")
    enc, dec = K.bpe_encoder(), K.bpe_decoder(skip_special_tokens=False)
    back = dec(enc(F.col("text")))
    return d.select("doc_id", F.md5(back).alias("decoded_md5"), F.length(back).cast("bigint").alias("decoded_chars"))


@query("cpt_train_eval_split", pack_sql(_DOC_SRC) + """
SELECT seq_id::BIGINT AS seq_id,
       CASE WHEN row_number() OVER (ORDER BY md5('42:' || seq_id::VARCHAR), seq_id)
                 <= ceil(0.05::DOUBLE * count(*) OVER ()) THEN 'eval' ELSE 'train' END AS split
FROM seqs
""")
def cpt_train_eval_split(spark, data_dir):
    """Packed sequences split into train / eval (fraction 0.05, seed 42)."""
    from scriptorium.operators import split as SP
    packed = P.pack_sequences(_doc_tokens(spark, data_dir), SEQ_LEN)
    return SP.train_eval_split(packed.select("seq_id"), "seq_id", 0.05, 42).select(
        F.col("seq_id").cast("bigint").alias("seq_id"), "split")
