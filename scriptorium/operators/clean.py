"""Boilerplate stripping and line-level cleaning of book texts.

The line loop of the cleaner is a small state machine (header, body,
licence). It has a closed form that needs no per-line state: with ``s`` the
first line matching START and ``e`` the first line matching END but not
START, line ``i`` survives iff ``s`` exists, ``s < i``, ``e`` is absent or
``i < e``, and ``i`` is not itself a START line. An END before START makes
the whole text empty, a line matching both markers counts as START.

Every operator here is a narrow projection: per-row array higher-order
functions in the JVM, no shuffle, no Python. The marker index array is
projected once and referenced by the later steps (Catalyst keeps it as its
own projection instead of inlining it twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as T

# Marker codes per line: 1 = START (wins over END on the same line), 2 = END.
_START, _END = 1, 2


def _marker_codes(lines: Column) -> Column:
    # Both markers begin with a literal "***": lines without it skip the
    # two case-folding regexes (an exact prefilter; most lines take it).
    return F.transform(
        lines,
        lambda l: F.when(~l.contains("***"), F.lit(0))
        .when(T.is_start_marker(l), F.lit(_START))
        .when(T.is_end_marker(l), F.lit(_END))
        .otherwise(F.lit(0)),
    )


def with_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_lines`` (split on ``\\n``), ``_mk`` (marker code per line) and
    ``_s`` / ``_e``: 1-based positions of the first START and first END line
    (0 when absent), computed once per row, not once per line."""
    return (
        df.withColumn("_lines", T.split_lines(F.col(text_col)))
        .withColumn("_mk", _marker_codes(F.col("_lines")))
        .withColumn("_s", F.array_position("_mk", _START))
        .withColumn("_e", F.array_position("_mk", _END))
    )


def marker_positions(df: DataFrame, text_col: str = "text") -> DataFrame:
    """First START line and first END line (0-based, NULL when absent)."""
    w = with_lines(df, text_col)
    s, e = F.col("_s"), F.col("_e")
    return w.withColumn("start_line", F.when(s > 0, s - 1).cast("bigint")).withColumn(
        "end_line", F.when(e > 0, e - 1).cast("bigint")
    ).drop("_lines", "_mk", "_s", "_e")


def _body_filter(missing_start: str):
    """Predicate over (line, 0-based index) for the closed-form state machine."""
    s, e = F.col("_s"), F.col("_e")  # 1-based, 0 when absent

    def keep(line: Column, i: Column) -> Column:
        pos = i + 1
        code = F.get(F.col("_mk"), i)
        if missing_start == "keep":
            after_start = pos > s
        else:
            after_start = (s > 0) & (pos > s)
        before_end = (e == 0) | (pos < e)
        return after_start & before_end & (code != _START)

    return keep


def body_lines(df: DataFrame, text_col: str = "text", missing_start: str = "empty") -> DataFrame:
    """Lines between the markers, stray START lines removed (``_body``)."""
    if missing_start not in ("empty", "keep"):
        raise ValueError("missing_start must be 'empty' or 'keep'")
    keep = _body_filter(missing_start)
    return with_lines(df, text_col).withColumn("_body", F.filter("_lines", keep)).drop("_lines", "_mk", "_s", "_e")


def strip_boilerplate(df: DataFrame, text_col: str = "text", out_col: str = "body",
                      missing_start: str = "empty") -> DataFrame:
    """Header and licence removal only, lines rejoined with ``\\n``."""
    return body_lines(df, text_col, missing_start).withColumn(
        out_col, F.array_join("_body", "\n")
    ).drop("_body")


def _line_clean(lines: Column) -> Column:
    """Numbering drops, punctuation map, hyphen runs, decoration drops."""
    kept = F.filter(lines, lambda l: ~T.is_numbering_line(l))
    normalized = F.transform(kept, lambda l: T.collapse_hyphens(T.normalize_punctuation(l)))
    return F.filter(normalized, lambda l: ~T.is_decoration_line(l))


def clean_corpus(df: DataFrame, text_col: str = "text", out_col: str = "clean",
                 missing_start: str = "empty") -> DataFrame:
    """The whole cleaner; a text cleaned to ``""`` stays a row."""
    b = body_lines(df, text_col, missing_start)
    joined = F.array_join(_line_clean(F.col("_body")), "\n")
    return b.withColumn(out_col, T.strip_ws(T.collapse_blank_lines(joined))).drop("_body")


def clean_stats(df: DataFrame, text_col: str = "text", clean_col: str = "clean") -> DataFrame:
    """Lines before and after (``splitlines`` counting) and characters after."""
    return (
        df.withColumn("lines_before", T.count_splitlines(F.col(text_col)))
        .withColumn("lines_after", T.count_splitlines(F.col(clean_col)))
        .withColumn("chars_after", F.length(clean_col).cast("bigint"))
    )


# Single-step operators, each usable on its own over a ``line`` column or text.

def drop_roman_lines(lines: Column) -> Column:
    return F.filter(lines, lambda l: ~T.is_roman_line(l))


def drop_page_numbers(lines: Column) -> Column:
    return F.filter(lines, lambda l: ~T.is_page_number_line(l))


def drop_decoration(lines: Column) -> Column:
    return F.filter(lines, lambda l: ~T.is_decoration_line(l))
