"""DuckDB formulations of the operators, used as the correctness oracle.

The SQL states its own constants: a change to a pattern of the Spark code does
not move the oracle with it, and shows as a difference. Frame parts are shared,
as they are input. DuckDB arrays and lambda indexes are 1-based.
"""

from __future__ import annotations

from scriptorium.plans import fixtures
from scriptorium.plans import sql as S

# Fixed values, stated a second time on purpose (see above).
_WS = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
START_RE = rf"\*\*\*[{_WS}]*START[{_WS}]+(?:OF[{_WS}]+)?(?:THE[{_WS}]+)?PROJECT[{_WS}]+GUTENBERG"
END_RE = rf"\*\*\*[{_WS}]*END[{_WS}]+(?:OF[{_WS}]+)?(?:THE[{_WS}]+)?PROJECT[{_WS}]+GUTENBERG"
ROMAN_LINE_RE = rf"^[{_WS}]*[IVXLCDM]+\.?[{_WS}]*\z"
PAGE_NUMBER_RE = rf"^[{_WS}]*-?[{_WS}]*\p{{Nd}}+[{_WS}]*-?[{_WS}]*\z"
BRACED_NUMBER_RE = rf"^[{_WS}]*\{{[{_WS}]*\p{{Nd}}+[{_WS}]*\}}[{_WS}]*\z"
DECORATION_LINE_RE = rf"^[{_WS}]*[*_=#$%&~+][{_WS}*_=#$%&~+]*\z"
SPLITLINES_RE = r"\r\n|[\x{0a}-\x{0d}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
PUNCT_FROM, PUNCT_TO, EM_DASH = "\u2018\u2019\u201c\u201d\u2013", "\'\'\"\"-", "\u2014"
WS_CHARS = S.lit("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def splitlines_count(x: str) -> str:
    r = S.regex(SPLITLINES_RE)
    tail = S.regex(f"(?:{SPLITLINES_RE})\\z")
    return (
        f"(len(regexp_extract_all({x}, {r})) + "
        f"CASE WHEN {x} = '' OR regexp_matches({x}, {tail}) THEN 0 ELSE 1 END)::BIGINT"
    )


def marker_code(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, {S.regex(START_RE)}, 'i') THEN 1 "
        f"WHEN regexp_matches({x}, {S.regex(END_RE)}, 'i') THEN 2 ELSE 0 END"
    )


def line_clean(lines: str) -> str:
    numbering = " OR ".join(f"regexp_matches(x, {S.regex(r)})" for r in (ROMAN_LINE_RE, PAGE_NUMBER_RE, BRACED_NUMBER_RE))
    decoration = S.regex(DECORATION_LINE_RE)
    norm = (
        f"regexp_replace(replace(translate(x, {S.lit(PUNCT_FROM)}, {S.lit(PUNCT_TO)}), "
        f"{S.lit(EM_DASH)}, '--'), '---?', '--', 'g')"
    )
    kept = f"list_filter({lines}, lambda x: NOT ({numbering}))"
    normalized = f"list_transform({kept}, lambda x: {norm})"
    return f"list_filter({normalized}, lambda x: NOT regexp_matches(x, {decoration}))"


def framed_cte() -> str:
    return f"framed AS ({fixtures.framed_sql('documents')})"


def marker_ctes(src: str = "framed") -> str:
    """CTEs ``lm`` (lines, marker codes, s, e; 1-based, 0 when absent) and ``body``."""
    return (
        f"lm0 AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM {src}), "
        f"lm1 AS (SELECT *, list_transform(lines, lambda x: {marker_code('x')}) AS mk FROM lm0), "
        f"lm AS (SELECT *, coalesce(list_position(mk, 1), 0) AS s, "
        f"coalesce(list_position(mk, 2), 0) AS e FROM lm1), "
        f"body AS (SELECT doc_id, text, list_filter(lines, lambda x, i: s > 0 AND i > s "
        f"AND (e = 0 OR i < e) AND mk[i] <> 1) AS body FROM lm)"
    )


def collapsed_body_sql() -> str:
    """The cleaned body lines joined, blank runs collapsed (before the strip)."""
    joined = f"array_to_string({line_clean('body')}, chr(10))"
    return f"regexp_replace({joined}, {S.regex(chr(92) + 'n{3,}')}, chr(10) || chr(10), 'g')"


def cleaned_ctes() -> str:
    """``framed``, markers, ``cleaned(doc_id, text, clean)``."""
    return (
        f"{framed_cte()}, {marker_ctes()}, "
        f"cleaned AS (SELECT doc_id, text, {strip_ws(collapsed_body_sql())} AS clean FROM body)"
    )
