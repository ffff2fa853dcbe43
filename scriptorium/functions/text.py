"""Column-level text functions shared by the cleaning operators.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside the JVM (whole-stage codegen for scalar parts, interpreted higher-order
functions for array parts) and never round-trips through Python.

The regular expressions are written so that the same pattern text is valid in
Java regex (Spark) and RE2 (DuckDB, used by the oracle queries): whitespace is
an explicit class instead of ``\\s`` (the engines disagree on ``\\s``), digits
are ``\\p{Nd}`` and the end anchor is ``\\z``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
#
# Whitespace as Python's str.isspace()/str.strip() sees it:
#   U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
#   U+2028, U+2029, U+202F, U+205F, U+3000
# Boilerplate markers (case-insensitive, searched anywhere in the line):
#   ***<ws>START<ws+>(OF<ws+>)?(THE<ws+>)?PROJECT<ws+>GUTENBERG
#   ***<ws>END<ws+>(OF<ws+>)?(THE<ws+>)?PROJECT<ws+>GUTENBERG
# Line drops, on the whitespace-trimmed line:
#   Roman numerals:   [IVXLCDM]+ with an optional trailing "."
#   page numbers:     optional "-", decimal digits, optional "-" (ws between)
#   braced numbers:   "{" digits "}" (ws between)
#   decoration:       only whitespace and * _ = # $ % & ~ + (at least one char)
# Punctuation map: U+2018 U+2019 -> ', U+201C U+201D -> ", U+2013 -> -,
#   U+2014 -> --; then the regex ---? is rewritten to --.
# Blank-line runs: three or more \n become two.
# Python str.splitlines() separators:
#   \r\n, \n, \r, \v, \f, U+001C, U+001D, U+001E, U+0085, U+2028, U+2029
# ---------------------------------------------------------------------------

WS_RANGES = (
    "\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)
WS = f"[{WS_RANGES}]"

WS_CHARS = "".join(
    [chr(c) for c in range(0x09, 0x0E)]
    + [chr(c) for c in range(0x1C, 0x21)]
    + ["\u0085", "\u00a0", "\u1680"]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + ["\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
)


def _marker(word: str) -> str:
    return (
        f"\\*\\*\\*{WS}*{word}{WS}+(?:OF{WS}+)?(?:THE{WS}+)?PROJECT{WS}+GUTENBERG"
    )


# Case-insensitive with Unicode folding ("ſ" matches "S"), as Python's IGNORECASE.
START_RE = "(?iu)" + _marker("START")
END_RE = "(?iu)" + _marker("END")
# The line drops on a stripped line, where no two blank runs can meet: linear.
_ROMAN, _NUMBER, _BRACED = "[IVXLCDM]++\\.?", f"-?{WS}*+\\p{{Nd}}++{WS}*+-?", f"\\{{{WS}*+\\p{{Nd}}++{WS}*+\\}}"
STRIPPED_ROMAN_RE = f"^{_ROMAN}\\z"
STRIPPED_NUMBER_RE = f"^(?:{_NUMBER}|{_BRACED})\\z"
STRIPPED_NUMBERING_RE = f"^(?:{_ROMAN}|{_NUMBER}|{_BRACED})\\z"
DECORATION_CHARS = "\\*_=#\\$%&~\\+"
DECORATION_LINE_RE = f"^{WS}*[{DECORATION_CHARS}][{WS_RANGES}{DECORATION_CHARS}]*\\z"

PUNCT_FROM = "\u2018\u2019\u201c\u201d\u2013"
PUNCT_TO = "''\"\"-"
EM_DASH = "\u2014"
HYPHEN_RUN_RE = "---?"
BLANK_RUN_RE = "\n{3,}"

SPLITLINES_RE = (
    "\\r\\n|[\\x{0a}-\\x{0d}\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]"
)


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: trim the full Unicode whitespace set at both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def normalize_newlines(c: Column) -> Column:
    """Universal newlines on read: ``\\r\\n`` and a lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(c, "\\r\\n?", "\n")


def split_lines(c: Column) -> Column:
    """Split on ``\\n`` only, keeping empty lines (also a trailing one)."""
    return F.split(c, "\n", -1)


def is_start_marker(line: Column) -> Column:
    return line.rlike(START_RE)


def is_end_marker(line: Column) -> Column:
    return line.rlike(END_RE)


def is_roman_line(line: Column) -> Column:
    return strip_ws(line).rlike(STRIPPED_ROMAN_RE)


def is_page_number_line(line: Column) -> Column:
    return strip_ws(line).rlike(STRIPPED_NUMBER_RE)


def is_numbering_line(line: Column) -> Column:
    """Roman-numeral, page-number or braced-number line, in one regex pass."""
    return strip_ws(line).rlike(STRIPPED_NUMBERING_RE)


def normalize_punctuation(line: Column) -> Column:
    """Curly quotes and en dash map 1:1, the em dash maps to two hyphens."""
    return F.replace(F.translate(line, PUNCT_FROM, PUNCT_TO), F.lit(EM_DASH), F.lit("--"))


def collapse_hyphens(line: Column) -> Column:
    return F.regexp_replace(line, HYPHEN_RUN_RE, "--")


def is_decoration_line(line: Column) -> Column:
    return line.rlike(DECORATION_LINE_RE)


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, BLANK_RUN_RE, "\n\n")


def count_splitlines(c: Column) -> Column:
    """Number of elements Python's ``str.splitlines()`` would return."""
    tail = F.when((c == "") | c.rlike(f"(?:{SPLITLINES_RE})\\z"), 0).otherwise(1)
    return (F.regexp_count(c, F.lit(SPLITLINES_RE)) + tail).cast("bigint")
