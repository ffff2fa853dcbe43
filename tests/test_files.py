"""Files that vanish, cannot be read or are longer than a task should hold."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import clean as C
from scriptorium.operators import long_books as LB
from scriptorium.plans import fixtures
from scriptorium.sources import corpus as CO
from scriptorium.sources import files as FI


def _tree(files):
    root = tempfile.mkdtemp(prefix="scriptorium-files-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def test_listing_is_that_of_a_glob(spark):
    root = _tree({f"{d}/{n}": b"x" * i for d in ("a", "a/b/c", "_d", ".h", "e") for i, n in enumerate(("1.txt", "_2 %20#?.txt", ".3.txt", "4.TXT", "5.md"))})
    files, lost = FI.list_files(spark, root, ".txt")
    want = {f"{d}/{n}": i for d in ("a", "a/b/c", "_d", "e") for i, n in enumerate(("1.txt", "_2 %20#?.txt"))}
    assert {os.path.relpath(r.path.removeprefix("file://"), root): r.length for r in files.collect()} == want
    assert lost.count() == 0
    assert {r.reason for r in FI.read_files(files).collect()} == {None}
    one, _ = FI.list_files(spark, root + "/a/1.txt", ".txt")
    assert one.count() == 1


def test_vanished_changed_and_unreadable_files_are_rows_of_the_audit(spark):
    root = _tree({f"{n}.txt": n.encode() for n in ("kept", "gone", "grown", "folder", "also")} | {"bad.txt": b"\xff"})
    files, lost = CO.scan_corpus(spark, root)
    os.unlink(f"{root}/gone.txt")
    with open(f"{root}/grown.txt", "ab") as f:
        f.write(b" more")
    os.unlink(f"{root}/folder.txt")
    os.mkdir(f"{root}/folder.txt")
    good, audit = CO.decode_files(files)
    assert sorted(r.text for r in good.collect()) == ["also", "kept"]
    reasons = {os.path.basename(r.path): r.reason for r in audit.collect()}
    assert reasons.pop("folder.txt").startswith("unreadable: ")
    assert reasons == {"gone.txt": FI.MISSING, "grown.txt": FI.CHANGED, "bad.txt": FI.NOT_UTF8}


def test_a_file_without_permission_does_not_fail_the_load(spark, monkeypatch):
    """As root every file can be read, so the error is made by the store."""
    root = _tree({"a.txt": b"text", "b.txt": b"other"})
    books, audit = CO.load_books(spark, root)
    assert books.count() == 2 and audit.count() == 0
    calls = []

    def fails(times, error):
        def action():
            calls.append(1)
            if len(calls) <= times:
                raise error
            return "read"
        return action

    monkeypatch.setattr(FI, "PAUSE_S", 0)
    assert FI._tried(fails(9, PermissionError())) == (None, "unreadable: PermissionError") and len(calls) == 1
    calls.clear()
    assert FI._tried(fails(2, OSError("timed out"))) == ("read", None) and len(calls) == 3
    calls.clear()
    assert FI._tried(fails(9, OSError("timed out"))) == (None, "unreadable: OSError")


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 10_000])
def test_ranges_hold_every_line_once(spark, piece):
    rng = random.Random(piece)
    pieces = [b"\n", b"\r", b"\r\n", b"a", "é".encode(), " ".encode(), b"word word", b"\x0b", b"x" * 40]
    data = {f"{i}.txt": b"".join(rng.choice(pieces) for _ in range(rng.randrange(0, 25))) for i in range(12)} | {"e.txt": b"", "n.txt": b"\r\n"}
    root = _tree(data)
    files, _ = FI.list_files(spark, root, ".txt")
    rows = FI.read_ranges(FI.ranges(files, piece)).collect()
    for name, raw in data.items():
        own = sorted((r for r in rows if r.path.endswith("/" + name)), key=lambda r: r.piece)
        assert "".join(r.text for r in own) == raw.decode().replace("\r\n", "\n").replace("\r", "\n")
        assert [r.last for r in own].count(True) == 1
        held = [r for r in own if r.text]
        assert all(r.text.endswith("\n") for r in held[:-1]) and (not held or held[-1].last)


def book(rng):
    lines = [fixtures.HEADER, fixtures.START, fixtures.END, fixtures.STRAY_START, fixtures.END_SHORT, fixtures.START_AND_END, fixtures.DEBRIS,
             "", "", "", "", "   ", "\t", " ", "plain line", "  indented ", "XIV.", "12", "——", "* * *", "tail  ", " ", "a b"]
    body = [rng.choice(lines) for _ in range(rng.randrange(0, 30))]
    if rng.random() < 0.8:
        body.insert(rng.randrange(0, 3) if body else 0, fixtures.START)
    return rng.choice(["\n", "\r\n"]).join(body) + rng.choice(["", "\n", "\n\n\n", "  \n "])


@pytest.mark.parametrize("piece,missing_start", [(1, "empty"), (13, "keep"), (60, "empty"), (200, "keep"), (1 << 20, "empty")])
def test_cleaning_in_ranges_equals_the_row_form(spark, piece, missing_start):
    rng = random.Random(piece)
    data = {f"{i:03d}.txt": book(rng).encode() for i in range(60)} | {"bad.txt": fixtures.START.encode() + b"\nline\n" * 9 + b"\xff\n" + b"line\n" * 9}
    root = _tree(data)
    books = LB.clean_ranges(spark, root, piece, missing_start)
    parts = {}
    for r in sorted(books.parts.collect(), key=lambda r: r.part):
        parts[os.path.basename(r.path)] = parts.get(os.path.basename(r.path), "") + r.text
    rows, audit = CO.load_books(spark, root)
    want = C.clean_stats(C.clean_corpus(rows.withColumn("name", F.concat("name", F.lit(".txt"))), missing_start=missing_start)).collect()
    assert parts == {r.name: r.clean for r in want}
    stats = {os.path.basename(r.path): r for r in LB.range_stats(books).collect()}
    for r in want:
        s = stats[r.name]
        assert (s.lines_before, s.lines_after, s.chars_after) == (r.lines_before, r.lines_after, r.chars_after), r.name
    assert [(os.path.basename(r.path), r.reason) for r in books.audit.collect()] == [("bad.txt", FI.NOT_UTF8)] == [
        (os.path.basename(r.path), r.reason) for r in audit.collect()]


def test_a_long_book_is_cleaned_by_many_tasks(spark):
    """A book of 6 MB in ranges of 128 KB: no row holds more than a range."""
    rng = random.Random(1)
    lines = ["word " * 12, "", "", "", "XII.", "* * *", "line — end"]
    text = "\n".join([fixtures.HEADER, fixtures.START, *rng.choices(lines, k=500_000), fixtures.END, fixtures.LICENCE])
    root = _tree({"long.txt": text.encode()})
    assert len(text) > 6_000_000
    books = LB.clean_ranges(spark, root, 1 << 17)
    sizes = books.parts.selectExpr("count(*) n", "max(length(text)) m").first()
    assert sizes.n > 40 and sizes.m < 1.1 * (1 << 17)
    got = "".join(r.text for r in books.parts.orderBy("part").toLocalIterator())
    (want,) = C.clean_corpus(spark.createDataFrame([(text,)], "text string")).select("clean").collect()
    assert got == want.clean


def test_texts_are_written_a_row_at_a_time(spark):
    from scriptorium.sources import sinks

    root = tempfile.mkdtemp(prefix="scriptorium-texts-")
    rows = [("a/x.txt", "é" * 10, "latin-1"), ("b.txt", None, None), ("c.txt", "日é", "latin-1"), ("d.txt", "日", None)]
    df = spark.createDataFrame(rows, "relpath string, text string, encoding string")
    out = sinks.write_text_files(df, root, encoding_col="encoding")
    assert "MapInArrow" in out._jdf.queryExecution().toString()
    assert dict(map(tuple, out.collect())) == {"a/x.txt": 10, "b.txt": 0, "c.txt": 2, "d.txt": 3}
    with open(f"{root}/c.txt", "rb") as f:
        assert f.read() == b"?\xe9"
