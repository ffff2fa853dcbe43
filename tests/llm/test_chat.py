import hashlib

import pytest
from pyspark.sql import functions as F

from scriptorium.llm.chat_prefix import (
    flat_examples, format_conversations, parse_turn, read_back, read_examples, unescape, write_examples)
from tests.llm.helpers import frame

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</turn>", "### user:\n", "\\", "\\\\### Assistant: </turn> ok", "a:b#c<d>\n</turn>\n", "", "😀 é", "x" * 200_000]


def turns():
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "user", None), (2, 2, "assistant", None), (2, 2, "assistant", "again")]
    rows += [(3, 0, "a:s#s\\", "odd role"), (None, None, None, None), (4, 0, "user", "no reply")]
    return rows


def test_round_trip_and_loss(spark):
    formatted = format_conversations(frame(spark, turns(), SCHEMA, ["segment", "start", "example"]))
    rows = sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.position))
    given = sorted([(str(c), -1 if t is None else t, r or "", x or "") for c, t, r, x in turns()])
    assert [(str(r.conv_id), *parse_turn(r.segment)) for r in rows] == [(c, r, x) for c, _, r, x in given]
    digests = {r.conv_id: r for r in read_back(formatted).collect()}
    for conv in (1, 2, 3, 4, None):
        own = [(r, x) for c, _, r, x in given if c == str(conv)]
        loss = "".join(x for r, x in own if r == "assistant")
        assert digests[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert (digests[conv].n_turns, digests[conv].loss_chars) == (len(own), len(loss))
        assert digests[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_flat_examples(spark):
    formatted = format_conversations(spark.createDataFrame(turns(), SCHEMA))
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: r.position):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    examples = flat_examples(formatted).collect()
    assert len(examples) == sum(r == "assistant" for _, _, r, _ in turns())
    for e in examples:
        assert whole[e.conv_id].startswith(e.text) and e.text.endswith("\n</turn>\n")
        assert unescape(e.text[e.loss_start:e.loss_end]) in {t or "" for _, _, r, t in turns() if r == "assistant"}
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_written_examples_are_what_is_read(spark):
    long = [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(201)]
    written = write_examples(format_conversations(spark.createDataFrame(turns() + long, SCHEMA)))
    rows = written.where("conv_id = 5").withColumn("part", F.input_file_name()).collect()
    replies = sorted((r for r in rows if r.example is not None), key=lambda r: r.example)
    assert [r.example for r in replies] == list(range(100)) and len({r.part for r in replies}) > 1
    for k, r in enumerate(replies):
        assert r.text == "".join(f"### {role}:\n{text}\n</turn>\n" for _, _, role, text in long[:2 * k + 2])
    assert [parse_turn(r.text) for r in rows if r.example is None] == [("user", "turn 200")]
    digest = read_examples(written).where("conv_id = 5").first()
    assert digest.formatted_chars == sum(len(r.text) for r in replies) and digest.n_turns == 201
    # a turn that only one example's context has wrong is found
    other = F.when((F.col("conv_id") == 5) & (F.col("example") == 50), F.regexp_replace("text", "turn 4\n", "turn 9\n"))
    with pytest.raises(Exception, match="context of example 50 of conversation 5"):
        read_examples(written.withColumn("text", F.coalesce(other, "text"))).collect()
