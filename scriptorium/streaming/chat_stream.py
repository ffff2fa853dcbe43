"""Incremental SFT example building from chat JSONL with Structured Streaming.

Each JSONL line is one conversation, so parsing, reject routing, system
injection, rendering, tokenising and masking are row-local and run per
micro-batch without state. Valid examples and rejects go to two Parquet
sinks with their own commit logs. A stream has no global line order, so
examples carry their file and a content hash instead of a position; the
train/eval split (which needs the whole key set) stays a batch step over
the accumulated table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY
from pyspark.sql.streaming import StreamingQuery

from scriptorium.functions import chat as CH
from scriptorium.operators import chat as M
from scriptorium.session import ship_package, stream_location as default_location
from scriptorium.sources.jsonl import parse_chat_lines


def read_jsonl_stream(spark: SparkSession, jsonl_dir: str, strict: bool = True,
                      extra: TY.StructType | None = None) -> DataFrame:
    lines = spark.readStream.schema("value string").text(jsonl_dir).select(
        "value", F.col("_metadata.file_path").alias("source_file"))
    return parse_chat_lines(lines, strict, extra).withColumn(
        "line_hash", F.xxhash64("source_file", F.to_json("messages")))


def sft_stream(messages: DataFrame, max_seq_len: int = 1024, tokenizer: str = "codepoints",
               template: CH.ChatTemplate = CH.CHATML, default_prompt: str = M.DEFAULT_SYSTEM_PROMPT,
               require_assistant_last: bool = False) -> tuple[DataFrame, DataFrame]:
    good, rejects = M.split_rejects(messages, require_assistant_last=require_assistant_last)
    keep = tuple(c for c in good.columns if c != "messages")
    ex = M.sft_examples(good, max_seq_len, tokenizer, template, default_prompt, keep=keep)
    return ex, rejects.withColumn("messages", F.to_json("messages"))


def start_sft_stream(spark: SparkSession, jsonl_dir: str, output_dir: str, checkpoint_location: str | None = None,
                     max_seq_len: int = 1024, tokenizer: str = "codepoints", available_now: bool = True,
                     extra: TY.StructType | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    ship_package(spark)
    ckpt = (checkpoint_location or default_location(spark, "sft", jsonl_dir, output_dir)).rstrip("/")
    ex, rejects = sft_stream(read_jsonl_stream(spark, jsonl_dir, extra=extra), max_seq_len, tokenizer)

    def start(df: DataFrame, sub: str) -> StreamingQuery:
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{ckpt}/{sub}")
             .option("path", f"{output_dir.rstrip('/')}/{sub}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        return w.start()

    return start(ex, "examples"), start(rejects, "rejected")
