"""Chat JSONL: one JSON object per non-blank line with a ``messages`` list.

Lines are stripped (Unicode whitespace) and blank ones skipped; each other
line must parse, carry ``messages``, and every message a ``role``;
otherwise the load fails (the check runs in the tasks, nothing is
collected). Extra keys are ignored. Records are numbered in file order. ``strict`` also rejects trailing data
after the object, which Spark's JSON reader tolerates; that check parses
each line once more with Python's ``json`` in Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from scriptorium.functions import chat as CH
from scriptorium.functions import text as T
from scriptorium.session import materialize

SCHEMA = TY.StructType([TY.StructField("messages", TY.ArrayType(TY.StructType([
    TY.StructField("role", TY.StringType()), TY.StructField("content", TY.StringType())])))])


@F.pandas_udf(TY.BooleanType())
def _single_json_value(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def ok(line: str) -> bool:
        try:
            json.loads(line)
            return True
        except ValueError:
            return False

    for s in batches:
        yield s.map(ok)


def parse_chat_lines(lines: DataFrame, strict: bool = True, extra: TY.StructType | None = None) -> DataFrame:
    """Raw ``value`` lines -> ``messages`` (+ ``extra`` fields), blank lines
    skipped, bad lines failing the job. Row-local, so it also runs on a stream."""
    schema = SCHEMA if extra is None else TY.StructType(SCHEMA.fields + extra.fields)
    kept = lines.withColumn("line", T.strip_ws(F.col("value"))).where(F.col("line") != "")
    parsed = kept.withColumn("_j", F.from_json("line", schema, {"mode": "FAILFAST"}))
    m = F.col("_j.messages")
    checks = [
        F.assert_true(F.is_valid_utf8("value"), F.lit("JSONL line is not valid UTF-8")),
        F.assert_true(m.isNotNull(), F.lit("JSONL line without 'messages'")),
        F.assert_true(~F.exists(m, lambda x: x["role"].isNull()), F.lit("message without 'role'")),
    ]
    if strict:
        checks.append(F.assert_true(_single_json_value(F.col("line")), F.lit("JSONL line is not one JSON value")))
    # Each assert is NULL when it holds. They stand in a filter, which column
    # pruning keeps: counting or selecting other columns fails on a bad line too.
    held = checks[0].isNull()
    for c in checks[1:]:
        held = held & c.isNull()
    parsed = parsed.where(held)
    extras = [F.col(f"_j.{f.name}").alias(f.name) for f in (extra.fields if extra else [])]
    keep = [c for c in lines.columns if c != "value"]
    return parsed.select(*keep, m.cast(CH.MESSAGES).alias("messages"), *extras)


def read_chat_jsonl(spark: SparkSession, path: str, strict: bool = True,
                    extra: TY.StructType | None = None) -> DataFrame:
    """``example_id, messages`` (``example_id`` = position in file order).

    The scan delivers the lines of a block in order, so records are numbered
    where they are read and written once: a prefix sum over one row per (file,
    block) gives the first number of each block. No record is shuffled while
    Spark can broadcast that table.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    checked = materialize(
        parse_chat_lines(lines, strict, extra).withColumn("_pos", F.monotonically_increasing_id()), "jsonl")
    blocks = checked.groupBy("_file", "_block").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row for each block that a scan task reads
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    first = materialize(blocks.select("_file", "_block", shift.alias("_shift")), "jsonl-offsets")
    return checked.join(first, ["_file", "_block"]).select(
        (F.col("_pos") + F.col("_shift")).alias("example_id"), "messages", *[f.name for f in (extra.fields if extra else [])])


def to_jsonl_lines(df: DataFrame, messages_col: str = "messages", extra: tuple[str, ...] = ()) -> DataFrame:
    """``value`` = one JSON object per row (``messages`` plus extra keys)."""
    return df.select(F.to_json(F.struct(F.col(messages_col).alias("messages"), *extra)).alias("value"))
