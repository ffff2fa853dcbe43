"""Chat / SFT example construction.

Conversation rows become one example each: messages are assembled in turn
order, a default system message is injected when none exists, the full
conversation and the prompt (all messages but the last, plus the generation
header) are rendered and tokenised, the full ids are right-truncated, and
the first ``min(prompt_len, len)`` labels are masked with -100. The mask is
length-based: the last message is the target whatever its role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import chat as CH
from scriptorium.functions import tokens as K

# The loss-ignore label and the default system prompt.
IGNORE = -100
DEFAULT_SYSTEM_PROMPT = "You are Plato."


def assemble_messages(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turn rows to ``(conv_col, messages)`` in turn order.

    One output row is one conversation, the unit a chat dataset stores per
    line. Turns are sorted inside the partitions of ``conv_col`` (a sort that
    spills) and streamed out as records through Arrow; no aggregation buffer
    holds a conversation, and a worker holds one batch and the record that is
    still open.
    """
    order = [conv_col, turn_col, role_col, text_col]
    kind = turns.schema[conv_col].dataType.simpleString()
    return turns.select(*order).repartition(conv_col).sortWithinPartitions(*order).mapInArrow(
        _stream_records, f"`{conv_col}` {kind}, messages {CH.MESSAGES}")


def _records(batch: pa.RecordBatch, bounds: np.ndarray, names: tuple[str, str]) -> pa.RecordBatch:
    """The rows between ``bounds`` as one record each."""
    messages = pa.StructArray.from_arrays([batch.column(2).cast(pa.string()), batch.column(3).cast(pa.string())], names=["role", "content"])
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(bounds[:-1])), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), messages)], names=list(names))


def _stream_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of sorted turns; the last conversation of a batch stays open
    until another key comes."""
    held: list[pa.RecordBatch] = []

    def closed() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return _records(whole, np.array([0, whole.num_rows]), names)

    names = ("", "messages")
    for batch in batches:
        if not batch.num_rows:
            continue
        names = (batch.schema.names[0], "messages")
        codes = pc.dictionary_encode(batch.column(0), null_encoding="encode").indices.to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
        if held and held[-1].column(0)[-1].as_py() == batch.column(0)[0].as_py():
            first = starts[1] if len(starts) > 1 else batch.num_rows
            held.append(batch.slice(0, first))
            starts = starts[1:]
            if not len(starts):
                continue
        if held:
            yield closed()
        if len(starts) > 1:
            yield _records(batch.slice(starts[0], starts[-1] - starts[0]), starts - starts[0], names)
        held = [batch.slice(starts[-1])]
    if held:
        yield closed()


def split_rejects(df: DataFrame, messages_col: str = "messages",
                  require_assistant_last: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejects (NULL or empty messages, a NULL role or content).

    The last message is the training target whatever its role (faithful
    default); ``require_assistant_last`` also rejects conversations that do
    not end on an assistant message.
    """
    m = F.col(messages_col)
    bad = (m.isNull() | (F.size(m) == 0)
           | F.exists(m, lambda x: x["role"].isNull() | x["content"].isNull()))
    reason = (F.when(m.isNull(), "messages missing").when(F.size(m) == 0, "messages empty")
              .otherwise("null role or content"))
    if require_assistant_last:
        not_assistant = F.coalesce(F.element_at(m, -1)["role"] != "assistant", F.lit(True))
        reason = F.when(bad, reason).otherwise("last message not assistant")
        bad = bad | not_assistant
    return df.where(~bad), df.where(bad).withColumn("reject_reason", reason)


def ensure_system(df: DataFrame, default_prompt: str = DEFAULT_SYSTEM_PROMPT,
                  messages_col: str = "messages") -> DataFrame:
    return df.withColumn(messages_col, CH.with_default_system(F.col(messages_col), default_prompt))


def render_texts(df: DataFrame, template: CH.ChatTemplate = CH.CHATML, messages_col: str = "messages") -> DataFrame:
    """``full_text`` (no generation prompt) and ``prompt_text`` (all but the
    last message, with the generation header)."""
    m = F.col(messages_col)
    return df.withColumn("full_text", CH.render(m, template)).withColumn(
        "prompt_text", CH.render(CH.all_but_last(m), template, add_generation_prompt=True))


def mask_prompt(ids: Column, prompt_len: Column) -> Column:
    return F.transform(ids, lambda x, i: F.when(i < prompt_len, F.lit(IGNORE)).otherwise(x))


def sft_examples(df: DataFrame, max_seq_len: int = 1024, tokenizer: str | K.TokenizerSpec = "codepoints",
                 template: CH.ChatTemplate = CH.CHATML, default_prompt: str = DEFAULT_SYSTEM_PROMPT,
                 messages_col: str = "messages", keep: tuple[str, ...] = ()) -> DataFrame:
    """``input_ids, attention_mask, labels, prompt_len`` per conversation.

    ``tokenizer`` is ``"codepoints"``, or a BPE tokenizer file or spec (both
    texts go through one Arrow pass). Conversations that
    :func:`split_rejects` rejects (no messages, a null role or content) have no
    example: dropping one message alone would train on another conversation.
    """
    good, _ = split_rejects(df, messages_col)
    r = render_texts(ensure_system(good, default_prompt, messages_col), template, messages_col)
    if tokenizer == "codepoints":
        # One id per code point: the prompt length is its character count, and
        # only the characters that stay are encoded.
        r = r.withColumn("_full", K.codepoint_ids(F.substring("full_text", 1, int(max_seq_len)))).withColumn(
            "_prompt_len", F.length("prompt_text"))
    else:
        pair = K.bpe_pair_encoder(tokenizer)(F.col("full_text"), F.col("prompt_text"))
        r = r.withColumn("_enc", pair).withColumn("_full", F.col("_enc.a")).withColumn(
            "_prompt_len", F.size("_enc.b"))
    ids = F.slice(F.col("_full"), 1, int(max_seq_len))
    r = r.withColumn("input_ids", ids)
    return r.select(
        *keep,
        "input_ids",
        F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        mask_prompt(F.col("input_ids"), F.col("_prompt_len")).alias("labels"),
        F.col("_prompt_len").cast("bigint").alias("prompt_len"),
    )


def inference_prompts(df: DataFrame, prompt_col: str = "prompt", system: Column | str | None = None,
                      template: CH.ChatTemplate = CH.CHATML) -> DataFrame:
    """Generation prompts: optional system message, then the user prompt
    (an empty or NULL prompt becomes ``"hello"``); no default system here."""
    user = F.coalesce(F.nullif(F.col(prompt_col), F.lit("")), F.lit("hello"))
    sys_col = F.lit(system) if isinstance(system, str) or system is None else system
    sys_col = F.nullif(sys_col.cast("string"), F.lit(""))
    msgs = F.filter(
        F.array(F.struct(F.lit("system").alias("role"), sys_col.alias("content")),
                F.struct(F.lit("user").alias("role"), user.alias("content"))),
        lambda m: m["content"].isNotNull())
    return df.withColumn("messages", msgs).withColumn(
        "prompt_text", CH.render(F.col("messages"), template, add_generation_prompt=True))


def completion_slice(ids: Column, prompt_len: Column) -> Column:
    """Generated ids after the first ``prompt_len`` (empty when none)."""
    return F.slice(ids, (prompt_len + 1).cast("int"), F.greatest(F.size(ids) - prompt_len, F.lit(0)).cast("int"))


def sft_examples_from_turns(turns: DataFrame, max_seq_len: int = 1024, template: CH.ChatTemplate = CH.CHATML,
                            default_prompt: str = DEFAULT_SYSTEM_PROMPT, conv_col: str = "conv_id",
                            turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Code-point SFT examples straight from turn rows, with bounded groups.

    Equal to ``sft_examples(assemble_messages(turns), tokenizer="codepoints")``
    but no conversation is ever collected whole: each message is rendered
    as its own piece, piece offsets inside the conversation come from the
    two-level running sum, the prompt length is a sum, and only pieces that
    start inside the first ``max_seq_len`` characters are regrouped, so a
    group holds at most ``max_seq_len`` ids even for a conversation holding
    a third of all rows. Per-conversation facts (last turn, has a system
    message, first offset) are one-row-per-conversation aggregates joined
    back (broadcast by Spark's size threshold, else a shuffle join whose hot
    keys AQE splits).
    """
    from scriptorium.operators.ordering import exclusive_running_sum

    L = int(max_seq_len)
    t = turns.select(F.col(conv_col).alias("_c"), F.lit(1).alias("_src"), F.col(turn_col).alias("_t"),
                     F.col(role_col).alias("role"), F.col(text_col).alias("content"))
    # a conversation with a null role or content has no example
    info = t.groupBy("_c").agg(F.max("_t").alias("_last"),
                               F.max((F.col("role") == "system").cast("int")).alias("_has_sys"),
                               F.count_if(F.col("role").isNull() | F.col("content").isNull()).alias("_nulls")
                               ).where("_nulls = 0").drop("_nulls")
    injected = info.where(F.col("_has_sys") == 0).select(
        "_c", F.lit(0).alias("_src"), F.lit(0).cast(t.schema["_t"].dataType).alias("_t"),
        F.lit("system").alias("role"), F.lit(default_prompt).alias("content"))
    msgs = t.unionByName(injected)
    piece = F.concat(F.lit(template.prefix), F.col("role"), F.lit(template.role_sep), F.col("content"),
                     F.lit(template.suffix))
    pieces = msgs.select("_c", "_src", "_t", piece.alias("_p"), F.length(piece).cast("bigint").alias("_n"))
    offs, _, _ = exclusive_running_sum(pieces.select("_c", "_src", "_t", "_n"), ["_c", "_src", "_t"], "_n", "_g")
    conv = offs.groupBy("_c").agg(F.min("_g").alias("_g0")).join(
        info.select("_c", "_last"), "_c")
    located = offs.join(conv, "_c").select(
        "_c", "_src", "_t", "_n", (F.col("_g") - F.col("_g0")).alias("_start"),
        ((F.col("_src") == 1) & (F.col("_t") == F.col("_last"))).alias("_is_last"))
    full = pieces.select("_c", "_src", "_t", "_p").join(located, ["_c", "_src", "_t"])
    prompt_len = full.groupBy("_c").agg(
        (F.sum(F.when(~F.col("_is_last"), F.col("_n")).otherwise(0))
         + F.lit(len(template.generation_header))).cast("bigint").alias("prompt_len"))
    head = full.where(F.col("_start") < L).select(
        "_c", F.struct("_start", F.substring("_p", 1, L).alias("_s")).alias("_x"))
    text = head.groupBy("_c").agg(F.array_sort(F.collect_list("_x")).alias("_xs")).select(
        "_c", F.substring(F.array_join(F.transform("_xs", lambda x: x["_s"]), ""), 1, L).alias("_head"))
    ex = text.join(prompt_len, "_c").withColumn("input_ids", K.codepoint_ids(F.col("_head")))
    return ex.select(
        F.col("_c").alias(conv_col), "input_ids",
        F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        mask_prompt(F.col("input_ids"), F.col("prompt_len")).alias("labels"),
        "prompt_len")
