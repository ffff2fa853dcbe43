"""Cleaning queries over the framed ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import clean as C
from scriptorium.plans import fixtures
from scriptorium.plans import oracle as O
from scriptorium.plans import sql as S
from scriptorium.plans.registry import query
from scriptorium.sources.tables import table


def _framed(spark, data_dir):
    return fixtures.framed_documents(table(spark, data_dir, "documents"))


def _md5_lines(c):
    return F.md5(F.array_join(c, "\n"))


# -- C1 / C2: per-line audit form ------------------------------------------------

@query("split_lines", f"""
WITH {O.framed_cte()}
SELECT doc_id, (u.i - 1)::BIGINT AS line_no, length(u.line)::BIGINT AS line_chars, md5(u.line) AS line_md5
FROM framed, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                             generate_subscripts(string_split(text, chr(10)), 1) AS i) u
""")
def split_lines(spark, data_dir):
    d = _framed(spark, data_dir)
    return d.select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "line")).select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"),
        F.length("line").cast("bigint").alias("line_chars"), F.md5("line").alias("line_md5"))


@query("trim_lines", f"""
WITH {O.framed_cte()}
SELECT doc_id, (u.i - 1)::BIGINT AS line_no, length({O.strip_ws('u.line')})::BIGINT AS trimmed_chars,
       md5({O.strip_ws('u.line')}) AS trimmed_md5
FROM framed, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                             generate_subscripts(string_split(text, chr(10)), 1) AS i) u
""")
def trim_lines(spark, data_dir):
    d = _framed(spark, data_dir)
    lines = d.select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "line"))
    t = T.strip_ws(F.col("line"))
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"),
                        F.length(t).cast("bigint").alias("trimmed_chars"), F.md5(t).alias("trimmed_md5"))


# -- C3-C5: markers and boilerplate -----------------------------------------------

@query("marker_positions", f"""
WITH {O.framed_cte()}, {O.marker_ctes()}
SELECT doc_id, CASE WHEN s > 0 THEN s - 1 END::BIGINT AS start_line,
       CASE WHEN e > 0 THEN e - 1 END::BIGINT AS end_line
FROM lm
""")
def marker_positions(spark, data_dir):
    return C.marker_positions(_framed(spark, data_dir)).select("doc_id", "start_line", "end_line")


@query("strip_boilerplate", f"""
WITH {O.framed_cte()}, {O.marker_ctes()}
SELECT doc_id, len(body)::BIGINT AS body_lines, md5(array_to_string(body, chr(10))) AS body_md5
FROM body
""")
def strip_boilerplate(spark, data_dir):
    b = C.body_lines(_framed(spark, data_dir))
    return b.select("doc_id", F.size("_body").cast("bigint").alias("body_lines"),
                    _md5_lines(F.col("_body")).alias("body_md5"))


# -- C6-C11: single line rules, applied to the body lines --------------------------

def _rule_sql(expr: str) -> str:
    return f"""
WITH {O.framed_cte()}, {O.marker_ctes()}, r AS (SELECT doc_id, {expr} AS kept FROM body)
SELECT doc_id, len(kept)::BIGINT AS kept_lines, md5(array_to_string(kept, chr(10))) AS kept_md5 FROM r
"""


def _rule_query(fn):
    def run(spark, data_dir):
        b = C.body_lines(_framed(spark, data_dir))
        kept = fn(F.col("_body"))
        return b.select("doc_id", F.size(kept).cast("bigint").alias("kept_lines"),
                        _md5_lines(kept).alias("kept_md5"))
    return run


_NORM = (f"regexp_replace(replace(translate(x, {S.lit(O.PUNCT_FROM)}, {S.lit(O.PUNCT_TO)}), "
         f"{S.lit(O.EM_DASH)}, '--'), '---?', '--', 'g')")

query("drop_roman_lines", _rule_sql(
    f"list_filter(body, lambda x: NOT regexp_matches(x, {S.regex(O.ROMAN_LINE_RE)}))"))(
    _rule_query(C.drop_roman_lines))

query("drop_page_numbers", _rule_sql(
    f"list_filter(body, lambda x: NOT (regexp_matches(x, {S.regex(O.PAGE_NUMBER_RE)}) "
    f"OR regexp_matches(x, {S.regex(O.BRACED_NUMBER_RE)})))"))(
    _rule_query(C.drop_page_numbers))

query("normalize_punctuation", _rule_sql(
    f"list_transform(body, lambda x: replace(translate(x, {S.lit(O.PUNCT_FROM)}, {S.lit(O.PUNCT_TO)}), "
    f"{S.lit(O.EM_DASH)}, '--'))"))(
    _rule_query(lambda lines: F.transform(lines, T.normalize_punctuation)))

query("collapse_hyphens", _rule_sql(
    "list_transform(body, lambda x: regexp_replace(x, '---?', '--', 'g'))"))(
    _rule_query(lambda lines: F.transform(lines, T.collapse_hyphens)))

query("drop_decoration", _rule_sql(
    f"list_filter(list_transform(body, lambda x: {_NORM}), "
    f"lambda x: NOT regexp_matches(x, {S.regex(O.DECORATION_LINE_RE)}))"))(
    _rule_query(lambda lines: C.drop_decoration(
        F.transform(lines, lambda l: T.collapse_hyphens(T.normalize_punctuation(l))))))


@query("collapse_blank_lines", f"""
WITH {O.framed_cte()}
SELECT doc_id, md5(regexp_replace(text, {S.regex(chr(92) + 'n{3,}')}, chr(10) || chr(10), 'g')) AS collapsed_md5,
       length(regexp_replace(text, {S.regex(chr(92) + 'n{3,}')}, chr(10) || chr(10), 'g'))::BIGINT AS collapsed_chars
FROM framed
""")
def collapse_blank_lines(spark, data_dir):
    d = _framed(spark, data_dir)
    c = T.collapse_blank_lines(F.col("text"))
    return d.select("doc_id", F.md5(c).alias("collapsed_md5"), F.length(c).cast("bigint").alias("collapsed_chars"))


# -- C12-C16: the whole cleaner ------------------------------------------------------

@query("clean_corpus", f"""
WITH {O.cleaned_ctes()}
SELECT doc_id, length(clean)::BIGINT AS clean_chars, {O.splitlines_count('clean')} AS clean_lines,
       md5(clean) AS clean_md5
FROM cleaned
""")
def clean_corpus(spark, data_dir):
    c = C.clean_corpus(_framed(spark, data_dir))
    return c.select("doc_id", F.length("clean").cast("bigint").alias("clean_chars"),
                    T.count_splitlines(F.col("clean")).alias("clean_lines"), F.md5("clean").alias("clean_md5"))


@query("clean_stats", f"""
WITH {O.cleaned_ctes()}
SELECT doc_id, {O.splitlines_count('text')} AS lines_before, {O.splitlines_count('clean')} AS lines_after,
       length(clean)::BIGINT AS chars_after
FROM cleaned
""")
def clean_stats(spark, data_dir):
    c = C.clean_stats(C.clean_corpus(_framed(spark, data_dir)))
    return c.select("doc_id", "lines_before", "lines_after", "chars_after")
