"""Chat / SFT queries over ``conversations`` (and ``benchmark`` for prompts)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from scriptorium.functions import chat as CH
from scriptorium.functions import tokens as K
from scriptorium.operators import batches as B
from scriptorium.operators import chat as M
from scriptorium.operators import dictionary_tokens as D
from scriptorium.operators import split as SP
from scriptorium.plans import sql as S
from scriptorium.plans.registry import query
from scriptorium.plans.token_queries import PAD_ID, ids_md5
from scriptorium.session import materialize
from scriptorium.sources.tables import table

SFT_LEN = 4096  # truncation, full masking and ordinary rows all occur at sf0.01
BATCH_SIZE, GRAD_ACCUM = 2, 8
EVAL_FRACTION, SEED = 0.05, 42
T = CH.CHATML


def _messages(spark, data_dir):
    return M.assemble_messages(table(spark, data_dir, "conversations"))


def _msg_md5(m):
    return F.md5(F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("\x1f"), x["content"])), "\x1e"))


def _examples(spark, data_dir, max_seq_len=SFT_LEN):
    return M.sft_examples(_messages(spark, data_dir), max_seq_len, keep=("conv_id",)).withColumnRenamed(
        "conv_id", "example_id")


# -- DuckDB side ---------------------------------------------------------------------

_PRE, _SEP, _SUF, _GEN = S.lit(T.prefix), S.lit(T.role_sep), S.lit(T.suffix), S.lit(T.generation_header)


def _render_sql(m: str) -> str:
    return (f"array_to_string(list_transform({m}, lambda x: {_PRE} || x.role || {_SEP} || x.content || {_SUF}), '')")


_MSG_CTES = f"""
msgs AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m
         FROM conversations GROUP BY conv_id),
norm AS (SELECT conv_id, CASE WHEN len(list_filter(m, lambda x: x.role = 'system')) > 0 THEN m
         ELSE list_prepend({{'role': 'system', 'content': {S.lit(M.DEFAULT_SYSTEM_PROMPT)}}}, m) END AS m FROM msgs),
rendered AS (SELECT conv_id, m, {_render_sql('m')} AS full_text,
             {_render_sql('m[1:len(m) - 1]')} || {_GEN} AS prompt_text FROM norm)
"""

_EX_CTES = _MSG_CTES + f""",
ex0 AS (SELECT conv_id AS example_id,
        list_transform(regexp_extract_all(full_text, '(?s).'), lambda c: unicode(c)) AS full_ids,
        length(prompt_text)::BIGINT AS prompt_len FROM rendered),
ex AS (SELECT example_id, full_ids[1:{SFT_LEN}] AS ids, prompt_len, len(full_ids) AS full_len FROM ex0),
exl AS (SELECT *, list_transform(ids, lambda x, i: CASE WHEN i <= prompt_len THEN -100 ELSE x END) AS labels
        FROM ex),
spl AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{SEED}:' || example_id::VARCHAR), example_id)
                       <= ceil({EVAL_FRACTION}::DOUBLE * count(*) OVER ()) THEN 'eval' ELSE 'train' END AS split
        FROM exl)
"""


def _ids_md5_sql(x: str) -> str:
    return f"md5(array_to_string({x}, ','))"


# -- M0-M5 -----------------------------------------------------------------------------

@query("assemble_messages", f"""
WITH {_MSG_CTES}
SELECT conv_id, len(m)::BIGINT AS n_messages,
       md5(array_to_string(list_transform(m, lambda x: x.role || chr(31) || x.content), chr(30))) AS messages_md5
FROM msgs
""")
def assemble_messages(spark, data_dir):
    m = _messages(spark, data_dir)
    return m.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                    _msg_md5(F.col("messages")).alias("messages_md5"))


@query("ensure_system", f"""
WITH {_MSG_CTES}
SELECT conv_id, len(m)::BIGINT AS n_messages,
       md5(array_to_string(list_transform(m, lambda x: x.role || chr(31) || x.content), chr(30))) AS messages_md5
FROM norm
""")
def ensure_system(spark, data_dir):
    m = M.ensure_system(_messages(spark, data_dir))
    return m.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                    _msg_md5(F.col("messages")).alias("messages_md5"))


@query("render_chat", f"""
WITH {_MSG_CTES}
SELECT conv_id, length(full_text)::BIGINT AS chat_chars, md5(full_text) AS chat_md5 FROM rendered
""")
def render_chat(spark, data_dir):
    r = M.render_texts(M.ensure_system(_messages(spark, data_dir)))
    return r.select("conv_id", F.length("full_text").cast("bigint").alias("chat_chars"),
                    F.md5("full_text").alias("chat_md5"))


@query("render_prompt", f"""
WITH {_MSG_CTES}
SELECT conv_id, length(prompt_text)::BIGINT AS prompt_chars, md5(prompt_text) AS prompt_md5 FROM rendered
""")
def render_prompt(spark, data_dir):
    r = M.render_texts(M.ensure_system(_messages(spark, data_dir)))
    return r.select("conv_id", F.length("prompt_text").cast("bigint").alias("prompt_chars"),
                    F.md5("prompt_text").alias("prompt_md5"))


# -- M6-M10 ------------------------------------------------------------------------------

@query("sft_truncate", f"""
WITH {_EX_CTES}
SELECT example_id, full_len::BIGINT AS full_tokens, len(ids)::BIGINT AS n_tokens, {_ids_md5_sql('ids')} AS ids_md5
FROM ex
""")
def sft_truncate(spark, data_dir):
    r = M.render_texts(M.ensure_system(_messages(spark, data_dir)))
    full = K.codepoint_ids(F.col("full_text"))
    r = r.select(F.col("conv_id").alias("example_id"), full.alias("full"))
    ids = F.slice("full", 1, SFT_LEN)
    return r.select("example_id", F.size("full").cast("bigint").alias("full_tokens"),
                    F.size(ids).cast("bigint").alias("n_tokens"), ids_md5(ids).alias("ids_md5"))


_EX_SELECT = f"""
SELECT example_id, len(ids)::BIGINT AS n_tokens, prompt_len,
       len(list_filter(labels, lambda x: x = -100))::BIGINT AS n_masked,
       {_ids_md5_sql('ids')} AS ids_md5, {_ids_md5_sql('labels')} AS labels_md5,
       {_ids_md5_sql('list_transform(ids, lambda x: 1)')} AS mask_md5
FROM exl
"""


def _ex_out(e):
    return e.select(
        "example_id", F.size("input_ids").cast("bigint").alias("n_tokens"), "prompt_len",
        F.size(F.filter("labels", lambda x: x == -100)).cast("bigint").alias("n_masked"),
        ids_md5(F.col("input_ids")).alias("ids_md5"), ids_md5(F.col("labels")).alias("labels_md5"),
        ids_md5(F.col("attention_mask")).alias("mask_md5"))


@query("sft_examples", f"WITH {_EX_CTES} {_EX_SELECT}")
def sft_examples(spark, data_dir):
    return _ex_out(_examples(spark, data_dir))


@query("sft_examples_bpe")
def sft_examples_bpe(spark, data_dir):
    e = M.sft_examples(_messages(spark, data_dir), 1024, tokenizer=K.default_tokenizer_file(), keep=("conv_id",))
    return _ex_out(e.withColumnRenamed("conv_id", "example_id"))


# Words with an id of their own in the small vocabulary; any other pre-token
# is its code points.
TINY_WORDS = ["system", "user", "assistant", "im", "start", "end", "the", "of", "de", "la"]
TINY_PATTERN = "[A-Za-z]+|[0-9]|[^A-Za-z0-9]"
_TINY_IDS = "CASE w " + " ".join(f"WHEN {S.lit(w)} THEN [{D.FIRST_WORD_ID + i}]" for i, w in enumerate(TINY_WORDS)) + \
    " ELSE list_transform(regexp_extract_all(w, '(?s).'), lambda c: unicode(c)) END"


def _tiny_sql(text: str) -> str:
    return f"flatten(list_transform(regexp_extract_all({text}, '(?s){TINY_PATTERN}'), lambda w: {_TINY_IDS}))"


@query("sft_examples_dictionary", f"""
WITH {_MSG_CTES},
enc AS (SELECT conv_id AS example_id, {_tiny_sql('full_text')} AS full_ids, len({_tiny_sql('prompt_text')})::BIGINT AS prompt_len FROM rendered),
ex AS (SELECT example_id, full_ids[1:{SFT_LEN}] AS ids, prompt_len FROM enc),
exl AS (SELECT *, list_transform(ids, lambda x, i: CASE WHEN i <= prompt_len THEN -100 ELSE x END) AS labels FROM ex)
{_EX_SELECT}
""")
def sft_examples_dictionary(spark, data_dir):
    """Full text and prompt tokenised through one dictionary of their
    different pre-tokens."""
    e = D.sft_examples_dictionary(_messages(spark, data_dir), "conv_id", D.word_ids(TINY_WORDS), TINY_PATTERN, SFT_LEN)
    return _ex_out(e.withColumnRenamed("conv_id", "example_id"))


@query("sft_examples_dictionary_bpe")
def sft_examples_dictionary_bpe(spark, data_dir):
    """The same with byte-level BPE."""
    spec = K.bpe_spec(spark=spark)
    e = D.sft_examples_dictionary(_messages(spark, data_dir), "conv_id", D.bpe_ids(spec), D.BYTE_BPE_PATTERN, 1024)
    return _ex_out(e.withColumnRenamed("conv_id", "example_id"))


# -- M11-M14 -------------------------------------------------------------------------------

@query("train_eval_split", f"WITH {_EX_CTES} SELECT example_id, split FROM spl")
def train_eval_split(spark, data_dir):
    keys = _messages(spark, data_dir).select(F.col("conv_id").alias("example_id"))
    return SP.train_eval_split(keys, "example_id", EVAL_FRACTION, SEED).select("example_id", "split")


@query("sft_stage_counts", f"""
WITH {_EX_CTES}
SELECT 'raw' AS stage, count(*)::BIGINT AS n FROM msgs
UNION ALL SELECT 'normalized', count(*)::BIGINT FROM norm
UNION ALL SELECT 'tokenized', count(*)::BIGINT FROM exl
UNION ALL SELECT 'train', count(*)::BIGINT FROM spl WHERE split = 'train'
UNION ALL SELECT 'eval', count(*)::BIGINT FROM spl WHERE split = 'eval'
""")
def sft_stage_counts(spark, data_dir):
    """Counts observed in the one pass that writes the examples; the split is
    counted on the keys it wrote."""
    raw, norm, tokenized = Observation("raw"), Observation("normalized"), Observation("tokenized")
    count = F.count(F.lit(1)).alias("n")
    messages = M.ensure_system(_messages(spark, data_dir).observe(raw, count)).observe(norm, count)
    # tokenised means that there are ids
    examples = M.sft_examples(messages, SFT_LEN, keep=("conv_id",)).observe(tokenized, F.count("input_ids").alias("n"))
    written = materialize(examples.select("conv_id", "input_ids"), "stage-examples")
    split = SP.train_eval_split(written.select("conv_id"), "conv_id", EVAL_FRACTION, SEED)
    stages = [("raw", raw), ("normalized", norm), ("tokenized", tokenized)]
    counts = spark.createDataFrame([(s, o.get["n"]) for s, o in stages], "stage string, n bigint")
    by_split = split.groupBy(F.col("split").alias("stage")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.unionByName(by_split)


def _train_batches(spark, data_dir):
    ex = _examples(spark, data_dir)
    split = SP.train_eval_split(ex, "example_id", EVAL_FRACTION, SEED)
    train = split.where(F.col("split") == "train").withColumn("_h", SP.split_hash(F.col("example_id"), SEED))
    return B.assign_batches(train, ["_h", "example_id"], BATCH_SIZE, GRAD_ACCUM)


_BATCH_CTES = _EX_CTES + f""",
tr AS (SELECT *, (row_number() OVER (ORDER BY md5('{SEED}:' || example_id::VARCHAR), example_id) - 1)::BIGINT
              AS row_index FROM spl WHERE split = 'train'),
bt AS (SELECT *, row_index // {BATCH_SIZE} AS batch_id, row_index // {BATCH_SIZE * GRAD_ACCUM} AS step_id FROM tr)
"""


@query("assign_batches", f"""
WITH {_BATCH_CTES}
SELECT example_id, row_index, batch_id::BIGINT AS batch_id, step_id::BIGINT AS step_id FROM bt
""")
def assign_batches(spark, data_dir):
    b = _train_batches(spark, data_dir)
    return b.select("example_id", "row_index", "batch_id", "step_id")


@query("collate_pad", f"""
WITH {_BATCH_CTES},
pd AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) - len(ids) AS pad FROM bt)
SELECT example_id, batch_id::BIGINT AS batch_id, (len(ids) + pad)::BIGINT AS padded_len,
       {_ids_md5_sql(f'list_concat(ids, list_transform(range(pad), lambda x: {PAD_ID}))')} AS ids_md5,
       {_ids_md5_sql('list_concat(list_transform(ids, lambda x: 1), list_transform(range(pad), lambda x: 0))')}
         AS mask_md5,
       {_ids_md5_sql('list_concat(labels, list_transform(range(pad), lambda x: -100))')} AS labels_md5
FROM pd
""")
def collate_pad(spark, data_dir):
    p = B.collate_pad(_train_batches(spark, data_dir), PAD_ID)
    return p.select("example_id", "batch_id", F.size("input_ids").cast("bigint").alias("padded_len"),
                    ids_md5(F.col("input_ids")).alias("ids_md5"), ids_md5(F.col("attention_mask")).alias("mask_md5"),
                    ids_md5(F.col("labels")).alias("labels_md5"))


# -- M16, M17 -------------------------------------------------------------------------------

def _inference_sql(system: str | None) -> str:
    sys_part = f"{_PRE} || 'system' || {_SEP} || {S.lit(system)} || {_SUF} || " if system else ""
    text = (f"{sys_part}{_PRE} || 'user' || {_SEP} || coalesce(nullif(text, ''), 'hello') || {_SUF} || {_GEN}")
    return f"SELECT item_id, length({text})::BIGINT AS prompt_chars, md5({text}) AS prompt_md5 FROM benchmark"


def _inference(spark, data_dir, system):
    b = table(spark, data_dir, "benchmark")
    p = M.inference_prompts(b, "text", system)
    return p.select("item_id", F.length("prompt_text").cast("bigint").alias("prompt_chars"),
                    F.md5("prompt_text").alias("prompt_md5"))


query("render_inference_prompt", _inference_sql(None))(lambda spark, d: _inference(spark, d, None))
query("render_inference_prompt_system", _inference_sql(M.DEFAULT_SYSTEM_PROMPT))(
    lambda spark, d: _inference(spark, d, M.DEFAULT_SYSTEM_PROMPT))


@query("completion_slice", f"""
WITH {_MSG_CTES},
c AS (SELECT conv_id, list_transform(regexp_extract_all(full_text, '(?s).'), lambda c: unicode(c)) AS ids,
             length(prompt_text) AS plen FROM rendered),
s AS (SELECT conv_id, array_to_string(list_transform(ids[plen + 1:], lambda x: chr(x)), '') AS completion FROM c)
SELECT conv_id, length(completion)::BIGINT AS n_completion, md5(completion) AS completion_md5 FROM s
""")
def completion_slice(spark, data_dir):
    """Prompt + continuation ids (the rendered conversation stands in for a
    model's output) -> the continuation after the prompt length, decoded."""
    r = M.render_texts(M.ensure_system(_messages(spark, data_dir)))
    ids = K.codepoint_ids(F.col("full_text"))
    plen = F.size(K.codepoint_ids(F.col("prompt_text")))
    comp = K.codepoint_text(M.completion_slice(ids, plen))
    r = r.select("conv_id", comp.alias("completion"))
    return r.select("conv_id", F.length("completion").cast("bigint").alias("n_completion"),
                    F.md5("completion").alias("completion_md5"))


@query("sft_examples_turns", f"WITH {_EX_CTES} {_EX_SELECT}")
def sft_examples_turns(spark, data_dir):
    """``sft_examples`` built from turn rows without collecting conversations."""
    e = M.sft_examples_from_turns(table(spark, data_dir, "conversations"), SFT_LEN)
    return _ex_out(e.withColumnRenamed("conv_id", "example_id"))


@query("stream_sft_examples", f"WITH {_EX_CTES} {_EX_SELECT}")
def stream_sft_examples(spark, data_dir):
    """Conversations land as JSONL files; a Structured Streaming query
    (availableNow) builds the SFT examples into Parquet, read back here."""
    from pyspark.sql import types as TY

    from scriptorium.session import scratch_path
    from scriptorium.sources import jsonl as J
    from scriptorium.streaming.chat_stream import start_sft_stream

    base = scratch_path(spark, "sft-stream")
    msgs = M.assemble_messages(table(spark, data_dir, "conversations"))
    J.to_jsonl_lines(msgs, extra=(F.col("conv_id").alias("id"),)).write.text(f"{base}/in")
    extra = TY.StructType([TY.StructField("id", TY.LongType())])
    for q in start_sft_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", SFT_LEN, extra=extra):
        q.awaitTermination()
    got = spark.read.parquet(f"{base}/out/examples").withColumnRenamed("id", "example_id")
    return _ex_out(got)
