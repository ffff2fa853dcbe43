"""Corpus directory and JSONL edge cases on fresh temp directories."""

import os
import tempfile

import pytest

from scriptorium.sources import corpus as CO
from scriptorium.sources import jsonl as J


def _tree(files):
    root = tempfile.mkdtemp(prefix="scriptorium-corpus-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def test_no_txt_is_an_error(spark):
    root = _tree({"a/readme.md": b"x"})
    with pytest.raises(FileNotFoundError):
        CO.load_books(spark, root)
    with pytest.raises(FileNotFoundError):
        CO.load_books(spark, os.path.join(root, "missing"))


def test_undecodable_only_gives_empty_and_audit(spark):
    root = _tree({"bad.txt": b"\xff\xfe\x00abc"})
    books, audit = CO.load_books(spark, root)
    assert books.count() == 0
    assert [r.reason for r in audit.collect()] == ["invalid utf-8"]


def test_corpus_rules(spark):
    root = _tree({
        "a/x.txt": b"from a",
        "b/x.txt": b"from b\r\nline\rend",
        "b/y.v1.txt": b"\xef\xbb\xbfbom kept",
        "c/bad.txt": b"ok \xc3\x28 broken",
        "c/U.TXT": b"upper",
        "c/.dot.txt": b"hidden",
        "c/with space.txt": b"spaced",
        "d/a.txt": "é".encode(),
    })
    books, audit = CO.load_books(spark, root)
    got = {r.name: (r.ord, r.text) for r in books.collect()}
    assert set(got) == {"x", "y.v1", "with space", "a"}
    # x: text from the last path (b/x.txt), position of the first (a/x.txt)
    assert got["x"][1] == "from b\nline\nend"
    order = [n for n, _ in sorted(got.items(), key=lambda kv: kv[1][0])]
    assert order == ["x", "y.v1", "with space", "a"]
    assert got["y.v1"][1] == "﻿bom kept"
    assert [r.path.endswith("c/bad.txt") for r in audit.collect()] == [True]
    stats = {r.name: r.n_chars for r in CO.load_stats(books).collect()}
    assert stats["a"] == 1
    t = CO.dataset_totals(books).first()
    assert t.books == 4


def _jsonl(text):
    root = tempfile.mkdtemp(prefix="scriptorium-jsonl-")
    p = os.path.join(root, "data.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


GOOD = '{"messages": [{"role": "user", "content": "a"}], "extra": 1}'


def test_jsonl_blank_lines_and_order(spark):
    p = _jsonl("\n   \n" + GOOD + "\n\n" + GOOD.replace('"a"', '"b"') + "\n \t \n")
    rows = J.read_chat_jsonl(spark, p).orderBy("example_id").collect()
    assert [r.example_id for r in rows] == [0, 1]
    assert [r.messages[0].content for r in rows] == ["a", "b"]


@pytest.mark.parametrize("bad", [
    '{"messages": [}',                          # malformed
    GOOD + " trailing",                         # trailing garbage
    '{"other": 1}',                             # missing messages
    '{"messages": [{"content": "x"}]}',         # missing role
])
def test_jsonl_errors(spark, bad):
    p = _jsonl(GOOD + "\n" + bad + "\n")
    with pytest.raises(Exception):
        J.read_chat_jsonl(spark, p).collect()


def test_jsonl_reject_table_cases(spark):
    from scriptorium.operators import chat as M
    p = _jsonl('{"messages": []}\n{"messages": [{"role": "user", "content": null}]}\n' + GOOD + "\n")
    good, bad = M.split_rejects(J.read_chat_jsonl(spark, p))
    assert good.count() == 1 and bad.count() == 2


def test_jsonl_duplicate_key_last_wins(spark):
    line = ('{"messages": [{"role": "user", "content": "first"}], '
            '"messages": [{"role": "user", "content": "second"}]}')
    rows = J.read_chat_jsonl(spark, _jsonl(line + "\n")).collect()
    assert [m.content for m in rows[0].messages] == ["second"]


def test_bad_jsonl_fails_also_when_columns_are_pruned(spark, tmp_path):
    import pytest

    from scriptorium.sources.jsonl import read_chat_jsonl

    good = b'{"messages": [{"role": "user", "content": "x"}]}\n'
    for i, bad in enumerate((b'{"other": 1}\n', good.replace(b"x", b"\xff"))):
        path = tmp_path / f"{i}.jsonl"
        path.write_bytes(good + bad)
        for strict in (True, False):
            with pytest.raises(Exception, match="JSONL line"):
                read_chat_jsonl(spark, str(path), strict=strict).count()
