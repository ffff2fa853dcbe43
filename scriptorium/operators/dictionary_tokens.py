"""Tokenising through the dictionary of a corpus.

A tokenizer that cuts text into pre-tokens first gives each of them the same
ids wherever it stands. Spark finds the pre-tokens, aggregates the different
ones, has each encoded once, and joins the ids back to the different pre-tokens
of each text, which is then put together from its own small dictionary: the
local tokenizer sees the dictionary, not the corpus, and no join sees a
pre-token of a text twice. Full texts and prompts share one dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import chat as CH
from scriptorium.functions import tokens as K
from scriptorium.operators import chat as M
from scriptorium.session import materialize

# Fixed value: the pre-tokens of byte-level BPE (``(?U)``: Unicode classes).
BYTE_BPE_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ids of whole words come behind all code points
FIRST_WORD_ID = 0x110000
# characters whose pre-tokens a task takes apart
TASK_CHARS = 8 << 20

Encoder = Callable[[list[str]], list]


def word_ids(words: list[str]) -> Encoder:
    """A vocabulary of whole words; any other pre-token is its code points."""
    known = {w: [FIRST_WORD_ID + i] for i, w in enumerate(words)}
    return lambda texts: [known.get(t) or list(map(ord, t)) for t in texts]


def bpe_ids(spec: K.TokenizerSpec) -> Encoder:
    """Byte-level BPE of the shipped tokenizer."""
    return lambda texts: [e.ids for e in K._load(spec).encode_batch(texts, add_special_tokens=False)]


def pre_tokens(text: str, pattern: str):
    return F.regexp_extract_all(text, F.lit(f"({pattern})" if not pattern.startswith("(?U)") else f"(?U)({pattern[4:]})"), 1)


def encode_words(words: DataFrame, encode: Encoder) -> DataFrame:
    """``word, ids`` of the different values of ``word``, each encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.asarray(x, np.int32) for x in encode(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["word", "ids"])

    return materialize(words.select("word").distinct().mapInArrow(run, "word string, ids array<int>"), "token-dictionary")


@F.arrow_udf(K.IDS)
def _looked_up(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The ids of a text's pre-tokens, from the text's own words and their ids."""
    for batch in batches:
        for part in K._slices(*batch):
            found = []
            for text, words, ids in zip(*(column.to_pylist() for column in part)):
                known = dict(zip(words, ids))
                found.append(np.fromiter((i for w in text for i in known[w]), np.int32))
            yield pa.array(found, pa.list_(pa.int32()))


def sft_examples_dictionary(
    df: DataFrame, key: str, encode: Encoder, pattern: str, max_seq_len: int = 1024, template: CH.ChatTemplate = CH.CHATML,
    default_prompt: str = M.DEFAULT_SYSTEM_PROMPT,
) -> DataFrame:
    """``key, input_ids, attention_mask, labels, prompt_len`` as
    :func:`scriptorium.operators.chat.sft_examples` builds them.

    ``key`` must be unique. Only the first ``max_seq_len`` pre-tokens of a full
    text can give an id that stays, so no more of them are joined, each
    different one once; of a prompt, which may be long, only the counts of its
    different pre-tokens are. Tasks take about ``TASK_CHARS`` of text.
    """
    L = int(max_seq_len)
    good, _ = M.split_rejects(df)
    rendered = materialize(M.render_texts(M.ensure_system(good, default_prompt), template).select(key, "full_text", "prompt_text"), "rendered")
    chars = rendered.agg(F.sum(F.length("full_text"))).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // TASK_CHARS))
    rendered = rendered.repartition(parts, key)
    head = F.slice(pre_tokens("full_text", pattern), 1, L)
    words = F.concat(
        F.transform(F.array_distinct(head), lambda w: F.struct(w.alias("word"), F.lit(True).alias("stays"), F.lit(0).alias("n"))),
        F.transform(pre_tokens("prompt_text", pattern), lambda w: F.struct(w.alias("word"), F.lit(False).alias("stays"), F.lit(1).alias("n"))))
    # stays: the head of the full text holds the word; n: how often the prompt does
    pairs = materialize(rendered.select(key, F.explode(words).alias("w")).groupBy(key, F.col("w.word").alias("word")).agg(
        F.max("w.stays").alias("stays"), F.sum("w.n").alias("n")), "token-pairs")
    found = pairs.join(encode_words(pairs, encode), "word").repartition(parts, key).groupBy(key).agg(
        F.sum(F.col("n") * F.size("ids")).cast("bigint").alias("prompt_len"),
        F.collect_list(F.when(F.col("stays"), F.struct("word", "ids"))).alias("known"))
    ids = _looked_up(F.col("head"), F.col("known.word"), F.col("known.ids"))
    return rendered.select(key, head.alias("head")).join(found, key).select(key, F.slice(ids, 1, L).alias("input_ids"), "prompt_len").select(
        key, "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        M.mask_prompt(F.col("input_ids"), F.col("prompt_len")).alias("labels"), "prompt_len")
