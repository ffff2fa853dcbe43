"""The cleaner over ranges of files, for books of any length.

:func:`scriptorium.operators.clean.clean_corpus` holds a book in one row. Here
a file is read in ranges of whole lines by many tasks and gives the same text,
in parts:

1. A first reading finds the START and END lines of each range; a file's first
   ones are minima over ``(piece, line)`` of slim rows, and a file with a range
   that cannot be read or decoded goes to the audit as a whole.
2. A second reading, of the ranges between them alone, drops and rewrites lines
   with the same rules as the row form.
3. Runs of line feeds that meet at range borders are collapsed, and the ends of
   the book stripped, from slim counts of each range in a window over the
   ranges of a file.

No task holds more than a range and the line that leaves it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import clean as C
from scriptorium.session import materialize
from scriptorium.sources.files import list_files, ranges, read_ranges

PIECE_BYTES = 8 << 20


@dataclass
class Books:
    """``parts``: ``path, part, text``, the cleaned book in order of ``part``;
    a book cleaned to nothing is one empty part. ``paths``: ``path`` of every
    book. ``audit``: ``path, reason``. ``probe``: slim facts of each range as
    read."""

    parts: DataFrame
    paths: DataFrame
    audit: DataFrame
    probe: DataFrame


def _own_lines():
    """The lines of a range: behind its last line feed there is another line
    only where the file ends."""
    lines = T.split_lines(F.col("text"))
    return F.when(F.col("last"), lines).otherwise(F.slice(lines, 1, F.regexp_count("text", F.lit("\n"))))


def clean_ranges(spark: SparkSession, corpus_dir: str, piece_bytes: int = PIECE_BYTES, missing_start: str = "empty") -> Books:
    """Clean every ``*.txt`` file under ``corpus_dir`` in ranges of
    ``piece_bytes``. The parts of a file, joined in order, are its text as the
    row form cleans it."""
    if missing_start not in ("empty", "keep"):
        raise ValueError("missing_start must be 'empty' or 'keep'")
    files, lost = list_files(spark, corpus_dir, ".txt")
    pieces = materialize(ranges(files, piece_bytes), "book-ranges")
    read = C.with_lines(read_ranges(pieces))
    probe = materialize(read.select(
        "path", "piece", "reason", F.length("text").cast("bigint").alias("chars"), F.regexp_count("text", F.lit(T.SPLITLINES_RE)).cast("bigint").alias("seps"),
        F.when(F.col("last"), (F.col("text") != "") & ~F.col("text").rlike(f"(?:{T.SPLITLINES_RE})\\z")).alias("open_end"),
        F.when(F.col("_s") > 0, F.struct("piece", F.col("_s").alias("line"))).alias("s"),
        F.when(F.col("_e") > 0, F.struct("piece", F.col("_e").alias("line"))).alias("e")), "book-probe")
    marks = materialize(probe.groupBy("path").agg(F.min("s").alias("s"), F.min("e").alias("e"), F.min("reason").alias("reason")), "book-marks")
    good = marks.where("reason is null").drop("reason")

    inside = (F.col("s").isNull() | (F.col("piece") >= F.col("s.piece"))) & (F.col("e").isNull() | (F.col("piece") <= F.col("e.piece")))
    if missing_start == "empty":
        inside &= F.col("s").isNotNull()
    body = read_ranges(pieces.join(good, "path").where(inside))
    changed = F.assert_true(F.col("reason").isNull(), F.concat(F.lit("changed between two readings: "), F.col("path")))

    def survives(line, i):
        at = F.struct(F.col("piece"), (i + 1).cast("bigint").alias("line"))
        after = F.col("s").isNull() | (at > F.col("s"))
        return after & (F.col("e").isNull() | (at < F.col("e"))) & ~(line.contains("***") & T.is_start_marker(line))

    kept = C._line_clean(F.filter(_own_lines(), survives))
    joined = body.where(changed.isNull()).select("path", "piece", kept.alias("kept")).where(F.size("kept") > 0).select(
        "path", "piece", F.array_join("kept", "\n").alias("t"))
    trimmed = joined.select("path", "piece", "t", F.btrim("t", F.lit("\n")).alias("b"))
    collapsed = materialize(trimmed.select(
        "path", "piece", T.collapse_blank_lines(F.col("b")).alias("body"),
        (F.length("t") - F.length("b")).cast("bigint").alias("feeds"),
        (F.length(F.rtrim("t", F.lit("\n"))) - F.length("b")).cast("bigint").alias("lead"),
        (T.strip_ws(F.col("b")) == "").alias("blank")), "book-bodies")

    # feeds between two bodies: those around and between them and one for each join
    of_file = Window.partitionBy("path")
    before = of_file.orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = collapsed.select(
        "path", "piece", "lead", "feeds", "blank", (F.col("body") != "").alias("has_body"),
        F.sum(F.col("feeds") + 1).over(before).alias("upto"),
        F.min(F.when(~F.col("blank"), F.col("piece"))).over(of_file).alias("first"),
        F.max(F.when(~F.col("blank"), F.col("piece"))).over(of_file).alias("final"))
    level = F.col("upto") - (F.col("feeds") - F.col("lead"))  # without those behind the body
    gaps = counted.where("has_body and piece between first and final").select(
        "path", "piece", "first", "final",
        (level - F.lag(level).over(of_file.orderBy("piece"))).alias("gap"))
    text = F.col("body")
    text = F.when(F.col("piece") == F.col("first"), F.ltrim(text, F.lit(T.WS_CHARS))).otherwise(text)
    text = F.when(F.col("piece") == F.col("final"), F.rtrim(text, F.lit(T.WS_CHARS))).otherwise(text)
    text = F.concat(F.repeat(F.lit("\n"), F.least(F.coalesce("gap", F.lit(0)), F.lit(2)).cast("int")), text)
    parts = collapsed.select("path", "piece", "body").join(materialize(gaps, "book-gaps"), ["path", "piece"]).select(
        "path", F.col("piece").alias("part"), text.alias("text"))
    empty = good.select("path").join(counted.where("not blank").select("path").distinct(), "path", "left_anti").select(
        "path", F.lit(0).cast("bigint").alias("part"), F.lit("").alias("text"))
    audit = marks.where("reason is not null").select("path", "reason").unionByName(lost)
    return Books(parts.unionByName(empty), good.select("path"), audit, probe)


def range_stats(books: Books) -> DataFrame:
    """``path, lines_before, lines_after, chars_after`` (``splitlines``
    counting), as :func:`scriptorium.operators.clean.clean_stats`, by sums over
    ranges and parts."""
    before = books.probe.groupBy("path").agg(
        (F.sum("seps") + F.max(F.coalesce(F.col("open_end"), F.lit(False)).cast("int"))).cast("bigint").alias("lines_before"))
    after = books.parts.groupBy("path").agg(
        F.sum(F.regexp_count("text", F.lit(T.SPLITLINES_RE))).alias("seps"), F.sum(F.length("text")).cast("bigint").alias("chars_after"))
    # a cleaned text never ends with a line's end
    return after.join(before, "path").select(
        "path", "lines_before", (F.col("seps") + (F.col("chars_after") > 0).cast("int")).cast("bigint").alias("lines_after"), "chars_after")
