"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are its
context, and only that reply is trainable. :func:`format_conversations` keeps
each turn's formatted segment once, with its place in the conversation; an
example is the text from the conversation's start to the end of its reply's
segment, with the loss mask as a span of that text. :func:`write_examples`
writes the examples out, each with its whole context, and
:func:`read_examples` parses them again.

Template of a turn::

    ### role:
    text
    </turn>

Backslash, ``<`` and ``#`` inside a text or role (and ``:`` inside a role) are
preceded by a backslash, so neither ``### `` nor ``</turn>`` can come from a
text, and :func:`parse_turn` gives back exactly what went in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import freeing
from scriptorium.session import scratch_path

# replies of a conversation whose examples one group builds; its turns are dealt once to each
BLOCK = 16
# characters of examples in an Arrow batch, about
BATCH_CHARS = 1 << 22

HEAD, HEAD_END, TURN_END = "### ", ":\n", "\n</turn>\n"
_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n(.*)\n</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def _escape(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\<#{also}])", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = _TURN.fullmatch(segment).groups()
    return unescape(role), unescape(text)


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", trained_role: str = "assistant",
) -> DataFrame:
    """``conv_id, position, segment, start, example, loss_start, loss_end``,
    one row per turn.

    ``start`` is the segment's place in the conversation's text. Rows of
    trained turns carry the number of their ``example`` (from 0 in each
    conversation) and its loss span, in characters from the conversation's
    start; other rows have nulls there. Turns go by ``turn``, ties by role and
    text, null turns first; null roles and texts count as empty; rows with a
    null ``conv_id`` are one conversation. Repeated rows are turns of their
    own. Other columns are ignored; no turns give no rows.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    body = _escape(F.col("text"))
    head = F.concat(F.lit(HEAD), _escape(F.col("role"), ":"), F.lit(HEAD_END))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trained = F.col("role") == trained_role
    return (
        rows.withColumn("segment", F.concat(head, body, F.lit(TURN_END)))
        .withColumn("position", F.row_number().over(in_order) - 1)
        .withColumn("start", F.sum(F.length("segment").cast("long")).over(so_far) - F.length("segment"))
        .withColumn("example", F.when(trained, F.sum(trained.cast("int")).over(so_far) - 1))
        .withColumn("loss_start", F.when(trained, F.col("start") + F.length(head)))
        .withColumn("loss_end", F.when(trained, F.col("start") + F.length("segment") - len(TURN_END)))
        .select("conv_id", "position", "segment", "start", "example", "loss_start", "loss_end")
    )


def parse_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of all turns of an example. A ``<`` inside a turn never
    follows a line feed, so a turn's end is found by its characters alone."""
    *segments, rest = text.split(TURN_END)
    if rest:
        raise ValueError("an example does not end with a turn")
    return [parse_turn(segment + TURN_END) for segment in segments]


_EXAMPLES = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("example", pa.int64()), ("text", pa.string()),
                       ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_EXAMPLES_DDL = "conv_id long, position long, example long, text string, loss_start long, loss_end long"


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if chars >= BATCH_CHARS or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        group, text = None, ""
        for batch in freeing(batches):
            for row in batch.to_pylist():
                if row["block"] is None:
                    yield row | {"text": row["segment"]}
                    continue
                if group != (row["conv_id"], row["block"]):
                    group, text = (row["conv_id"], row["block"]), ""
                text += row["segment"]
                if row["example"] is not None and row["example"] // BLOCK == row["block"]:
                    yield row | {"text": text}

    return _in_batches(rows(), _EXAMPLES, lambda row: len(row["text"]))


def _expanded(formatted: DataFrame) -> DataFrame:
    """The examples, and each turn behind the last reply as a row of its own
    without ``example`` and loss span. The examples of a conversation are built
    in groups of ``BLOCK``, each from all the turns up to its last reply."""
    conversation = Window.partitionBy("conv_id")
    before = conversation.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    own = F.count("example").over(before)
    replies = F.count("example").over(conversation)
    first, last = F.floor(F.col("own") / BLOCK), F.floor((F.col("replies") - 1) / BLOCK)
    dealt = (
        formatted.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("own", own).withColumn("replies", replies)
        .withColumn("block", F.explode(F.when(F.col("own") < F.col("replies"), F.sequence(first, last))
                                       .otherwise(F.array(F.lit(None).cast("long")))))
        .select("conv_id", "block", F.col("position").cast("long").alias("position"), "segment",
                F.col("example").cast("long").alias("example"), "loss_start", "loss_end")
    )
    # a fixed number: groups that are small here may have large examples
    parts = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "position")
        .mapInArrow(_written_out, _EXAMPLES_DDL)
    )


def flat_examples(formatted: DataFrame) -> DataFrame:
    """``conv_id, example, text, loss_start, loss_end``: the examples with
    their whole context written out. The output of a conversation grows with
    the square of its turns; a worker holds one example's text at a time and a
    batch of them, and a long conversation is dealt to many tasks."""
    return _expanded(formatted).where("example is not null").drop("position")


def write_examples(formatted: DataFrame) -> DataFrame:
    """The examples as Parquet in the shared folder, read again: ``conv_id,
    position, example, text, loss_start, loss_end``. ``position`` is that of
    the reply. Turns behind the last reply belong to no example; they are rows
    of their own with a null ``example``. Examples of a conversation lie next
    to one another, so that zstd finds the context they share."""
    spark = formatted.sparkSession
    path = scratch_path(spark, "chat-examples")
    _expanded(formatted).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_PARSED = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("example", pa.int64()), ("chars", pa.int64()),
    ("context_turns", pa.int64()), ("context_sha256", pa.string()), ("n_turns", pa.int64()), ("turns", pa.string()),
    ("reply", pa.string())])
_PARSED_DDL = ("conv_id long, position long, example long, chars long, context_turns long, context_sha256 string, "
               "n_turns long, turns string, reply string")


def _parse_examples(trained_role: str):
    """Parses whole examples. The turns up to the reply before (the context
    that the example shares) are told by number and digest, later ones kept."""

    def parsed(row: dict) -> dict:
        turns = parse_turns(row["text"])
        out = {"conv_id": row["conv_id"], "position": row["position"], "example": row["example"], "chars": len(row["text"])}
        at = 0
        if row["example"] is not None:
            reply = unescape(row["text"][row["loss_start"]:row["loss_end"]])
            if turns[-1] != (trained_role, reply):
                raise ValueError(f"the loss span of example {row['example']} of conversation {row['conv_id']} is not its reply")
            at = max((i + 1 for i, (role, _) in enumerate(turns[:-1]) if role == trained_role), default=0)
            context = hashlib.sha256()
            for role, text in turns[:at]:
                context.update(f"{role}\n{text}\n".encode())
            out |= {"reply": reply, "context_turns": at, "context_sha256": context.hexdigest()}
        return out | {"n_turns": len(turns) - at, "turns": "".join(f"{role}\n{text}\n" for role, text in turns[at:])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (parsed(row) for batch in freeing(batches) for row in batch.to_pylist())
        return _in_batches(rows, _PARSED, lambda row: len(row["turns"]))

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64())])
    now, done = None, []

    def closed() -> dict:
        return now | {"turns_sha256": now["turns_sha256"].hexdigest(), "loss_sha256": now["loss_sha256"].hexdigest()}

    for batch in freeing(batches):
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now["conv_id"]:
                if now is not None:
                    done.append(closed())
                now = {"conv_id": row["conv_id"], "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0,
                       "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "n_examples": 0}
            if row["example"] is not None:
                given = row["example"], row["context_turns"], row["context_sha256"]
                if given != (now["n_examples"], now["n_turns"], now["turns_sha256"].hexdigest()):
                    raise ValueError(f"the context of example {row['example']} of conversation {row['conv_id']} "
                                     "is not the turns before")
                now["loss_chars"] += len(row["reply"])
                now["loss_sha256"].update(row["reply"].encode())
                now["formatted_chars"] += row["chars"]
                now["n_examples"] += 1
            now["n_turns"] += row["n_turns"]
            now["turns_sha256"].update(row["turns"].encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([closed()], schema)


def read_examples(examples: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Digests of written examples, one row per conversation: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``
    (characters of all examples, contexts included) and ``n_examples``.

    Every example is parsed whole, where it lies; its context must be the
    turns of the example before it, else an error is raised. Only the turns
    that an example adds and the digest of its context are shuffled."""
    return (
        examples.mapInArrow(_parse_examples(trained_role), _PARSED_DDL)
        .repartition("conv_id").sortWithinPartitions("conv_id", "position")
        .mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                              "formatted_chars long, n_examples long")
    )


def read_back(formatted: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Writes the examples of a formatted table and gives the digests of what
    was written, as :func:`read_examples`."""
    return read_examples(write_examples(formatted), trained_role)
