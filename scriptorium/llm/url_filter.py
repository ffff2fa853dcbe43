"""URL filtering by rules, host word segmentation and naive Bayes.

Longest-rule decisions come first. For the other urls, the names in host and
path (runs of letters) are cut into words by a unigram model: word counts are
taken over all page texts, and Viterbi picks the likeliest cut of every
distinct name. A multinomial naive Bayes classifier over the words, learned
from the urls that a rule decides, gives the verdict.

Names are cut once each, however many urls hold them, and their scores are
joined back; word and token counts stay distributed tables. Names and words
have any length: which pieces of a name may be counted words is decided in its
task by a bit table of bounded size, and those few meet the counts in a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm import bits
from scriptorium.llm.shared import freeing
from scriptorium.llm.textbytes import span_hashes, utf8
from scriptorium.session import materialize

# log probability that a word without a count loses by each letter
LETTER = 2.3
# spans of a name that are looked up at a time
SPANS = 1 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, ``host/path``)
    that fits, else nulls. A rule fits its host and all subdomains when the
    path starts with the rule's. Of equally long rules the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for how, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(how)).otherwise(verdict)
    return rule, verdict


def _names(host: Column, path: Column) -> Column:
    """Letter runs, and the lengths of digit runs as ``#n``, of host and path."""
    runs = F.regexp_extract_all(F.lower(F.concat_ws("/", host, path)), F.lit(r"(\p{L}+|[0-9]+)"), F.lit(1))
    return F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(r))).otherwise(r))


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` over all texts; markup between ``<`` and ``>`` is left out."""
    plain = F.lower(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "<[^>]*>", " "))
    words = F.regexp_extract_all(plain, F.lit(rf"(\p{{L}}+)"), F.lit(1))
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def cut(name: str, known: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """The likeliest words of ``name``: ``known`` has (start, length, log
    probability) of the counted words in it; any other piece has ``unknown -
    LETTER`` a letter. Of equally likely cuts, the one with the longest last
    words. Linear in the name and its known words."""
    by_end: dict[int, list[tuple[int, float]]] = {}
    for start, length, p in known:
        by_end.setdefault(start + length, []).append((start, p))
    best: list[tuple[float, int]] = [(0.0, 0)]
    # a piece without a count is best begun where this is greatest, whatever its end
    lead, lead_at = 0.0, 0
    for end in range(1, len(name) + 1):
        options = [(best[start][0] + p, -start) for start, p in by_end.get(end, ())]
        found, start = max([*options, (lead + unknown - LETTER * end, -lead_at)])
        best.append((found, -start))
        if found + LETTER * end > lead:
            lead, lead_at = found + LETTER * end, end
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def _cut_names(total: int):
    unknown = -math.log(total + 10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            rows = [
                (r["name"], [r["name"]] if r["name"].startswith("#") else
                 cut(r["name"], [(p["start"], p["length"], math.log(p["n"]) + unknown) for p in r["pieces"]], unknown))
                for r in batch.to_pylist()
            ]
            names, words = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return run


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in freeing(batches):
        buf, off = utf8(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(span_hashes(buf, off[:-1], off[1:], fold_case=False).view(np.int64))], names=["h"])


def _pieces(lengths: list[int], table: bits.Table):
    """The pieces of each name that may be counted words, by the hashes of all
    its spans of these byte lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.load(table)
        for batch in freeing(batches):
            buf, off = utf8(batch.column(1))
            data, off = buf[off[0]:off[-1]], off - off[0]
            letter = (data & 0xC0) != 0x80
            nth = np.concatenate([np.cumsum(letter) - letter, [letter.sum()]])
            row, ends = np.repeat(np.arange(batch.num_rows), np.diff(off)), np.repeat(off[1:], np.diff(off))
            first = nth[off[:-1]]
            begins = np.append(letter, True)
            for size in lengths:
                start = np.flatnonzero(letter & (np.arange(len(data)) + size <= ends))
                start = start[begins[start + size]]
                for lo in range(0, len(start), SPANS):
                    s = start[lo:lo + SPANS]
                    s = s[bits.held(known, span_hashes(data, s, s + size, fold_case=False))]
                    raw = data.tobytes() if len(s) else b""
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(row[s])), pa.array(nth[s] - first[row[s]]), pa.array(nth[s + size] - nth[s]),
                        pa.array([raw[a:a + size] for a in s.tolist()], pa.binary()).cast(pa.string()),
                    ], names=["id", "start", "length", "word"])

    return run


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` of the distinct ``names``, whole and of any length. The
    pieces that may be counted words meet the counts in a join; a name's pieces
    are as many as its counted words and few more."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    lengths = sorted(r[0] for r in counts.select(F.octet_length("word")).distinct().collect())
    table = bits.write(counts.select("word").mapInArrow(_hash_words, "h long"))
    named = materialize(names.withColumn("id", F.monotonically_increasing_id()), "names")
    spans = named.where(~F.col("name").startswith("#")).select("id", "name").mapInArrow(
        _pieces(lengths, table), "id long, start long, length long, word string")
    pieces = spans.join(counts, "word").groupBy("id").agg(F.collect_list(F.struct("start", "length", "n")).alias("pieces"))
    rows = named.join(pieces, "id", "left").select(
        "name", F.coalesce("pieces", F.expr("array()").cast("array<struct<start:bigint,length:bigint,n:bigint>>")).alias("pieces"))
    return rows.mapInArrow(_cut_names(total), "name string, words array<string>")


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per page.

    ``rules`` are (``allow`` or ``block``, ``host/path``); the longest that
    fits decides. Other urls are blocked when their ``score`` (log odds of the
    words of host and path under naive Bayes, learned from the urls that rules
    decide, every page counting once) is above 0; it is null where a rule
    decides. Null urls and urls without ``://`` have an empty host and path and
    get the prior's verdict. Repeated rows are judged each and ties of the
    score allow. Other columns are ignored; an empty table gives no rows.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, by_rule = longest_rule(F.col("host"), F.col("path"), rules)
    parsed = materialize(parsed.select("page_id", "host", "path", rule.alias("rule"), by_rule.alias("by_rule")), "urls")

    urls = materialize(
        parsed.groupBy("host", "path", "by_rule").agg(F.count("*").alias("n"))
        .withColumn("names", _names(F.col("host"), F.col("path"))), "url-names")
    per_name = urls.select("by_rule", "n", F.explode("names").alias("name")).groupBy("name").agg(
        F.coalesce(F.sum(F.when(F.col("by_rule") == "block", F.col("n"))), F.lit(0)).alias("block"),
        F.coalesce(F.sum(F.when(F.col("by_rule") == "allow", F.col("n"))), F.lit(0)).alias("allow"))
    per_name = materialize(per_name, "name-counts")
    counts = materialize(word_counts(pages, text_col), "word-counts")
    words = materialize(segment(per_name.select("name"), counts), "name-words")

    per_word = materialize(
        per_name.join(words, "name").select("block", "allow", F.explode("words").alias("word"))
        .groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "word-odds")
    sums = per_word.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0))).first()
    decided = urls.agg(
        F.coalesce(F.sum(F.when(F.col("by_rule") == "block", F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("by_rule") == "allow", F.col("n"))), F.lit(0))).first()
    prior = math.log((decided[0] + 1) / (decided[1] + 1))
    shift = math.log((sums[2] + sums[0] + 1) / (sums[1] + sums[0] + 1))
    odds = per_word.select("word", (F.log((F.col("block") + 1) / (F.col("allow") + 1)) + shift).alias("odds"))
    per_name_odds = (
        words.select("name", F.explode("words").alias("word")).join(odds, "word")
        .groupBy("name").agg(F.sum("odds").alias("odds"))
    )
    open_urls = urls.where("by_rule is null")
    scored = (
        open_urls.select("host", "path", F.explode("names").alias("name")).join(per_name_odds, "name")
        # whole millionths add up to the same sum in any order
        .groupBy("host", "path").agg(F.sum(F.round(F.col("odds") * 1_000_000).cast("long")).alias("odds"))
    )
    verdict = F.coalesce("by_rule", F.when(F.col("score") > 0, "block").otherwise("allow"))
    scores = open_urls.join(scored, ["host", "path"], "left").select(
        "host", "path", (F.coalesce(F.col("odds") / 1_000_000, F.lit(0.0)) + prior).alias("score"))
    return (
        parsed.where("by_rule is null").join(scores, ["host", "path"], "left")
        .unionByName(parsed.where("by_rule is not null").withColumn("score", F.lit(None).cast("double")))
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
    )
