"""The framed view of ``documents`` used by every cleaning query.

``documents`` holds plain prose without markers, so an unframed cleaning
query would return only empty texts. Each document is wrapped in one of
eight frames, chosen by ``doc_id % 8``; every row is kept. The frame is
built from the same parts in Spark and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.plans import sql as S

TEXT = object()  # placeholder for the document text

HEADER = "The Project Gutenberg eBook of Sample Works\nThis eBook is for the use of anyone anywhere."
START = "*** START OF THE PROJECT GUTENBERG EBOOK SAMPLE WORKS ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK SAMPLE WORKS ***"
LICENCE = "Updated editions will replace the previous one.\nSection 1. General Terms of Use"
START_LOWER = "***\u017ftart of project gutenberg ebook sample works"
END_SHORT = "*** END PROJECT GUTENBERG ***"
START_AND_END = "*** START OF THE PROJECT GUTENBERG EBOOK *** END OF THE PROJECT GUTENBERG EBOOK ***"
STRAY_START = "  *** START OF PROJECT GUTENBERG"

# Debris lines (property pool): numbering, decoration, dashes, quotes, blank runs.
DEBRIS = "\n".join([
    "XII. ", "I", "MIX", "CIVIL", "iv", "I am",
    "1984", "- 12 -", "12-", "{ 7 }", "\u0663",
    "\u2013 12 \u2013",
    "* * *", "===", "~ + ~", "--", "-", "---", "----", "-----", "\u2014\u2014",
    "\u201cQuoted,\u201d she said \u2014 \u2018yes\u2019 \u2013 no.",
    "", "", "", "",
    "", "   ", "", "",
    "trailing nbsp\u00a0", "line sep\u2028", "vtab\u000b",
    "\u001c",
    "  indented line kept  ",
])

FRAMES: list[list[object]] = [
    [TEXT],
    [HEADER, START, TEXT, END, LICENCE],
    [HEADER, END, START, TEXT],
    [START, TEXT],
    [START, TEXT, STRAY_START, "tail", END],
    [START_LOWER, TEXT, END_SHORT],
    [START_AND_END, TEXT, END],
    [HEADER, START, DEBRIS, TEXT, END, LICENCE],
]


def frame_column(doc_id: Column, text: Column) -> Column:
    k = doc_id % len(FRAMES)
    expr = None
    for i, parts in enumerate(FRAMES):
        cols = [text if p is TEXT else F.lit(p) for p in parts]
        value = cols[0] if len(cols) == 1 else F.concat_ws("\n", *cols)
        expr = F.when(k == i, value) if expr is None else expr.when(k == i, value)
    return expr


def framed_documents(documents: DataFrame, *extra: str) -> DataFrame:
    return documents.select(*extra, "doc_id", frame_column(F.col("doc_id"), F.col("text")).alias("text"))


def framed_sql(table: str = "documents", extra: str = "") -> str:
    """DuckDB: ``SELECT doc_id, text`` (plus ``extra`` columns) with the same frames."""
    whens = []
    for i, parts in enumerate(FRAMES):
        vals = ["text" if p is TEXT else S.lit(p) for p in parts]
        value = vals[0] if len(vals) == 1 else "concat_ws(chr(10), " + ", ".join(vals) + ")"
        whens.append(f"WHEN {i} THEN {value}")
    cols = f"{extra}, " if extra else ""
    return f"SELECT {cols}doc_id, CASE doc_id % {len(FRAMES)} {' '.join(whens)} END AS text FROM {table}"
