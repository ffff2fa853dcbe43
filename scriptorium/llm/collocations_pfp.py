"""Collocations of a corpus, counted on a prefix-free parse of it.

Every window of ``OVERLAP`` words whose hash is a multiple of ``PERIOD`` is a
trigger: a chunk of a text starts with one and ends with the next, so that
chunks overlap by those words, and passages that texts share fall into the
same chunks wherever they stand. Where no trigger comes for ``MOST_WORDS``
words, a chunk ends all the same. The different chunks and how often each
occurs are the parse's dictionary; phrases are counted inside the dictionary
alone, weighted. A phrase belongs to the chunk in which it starts before the
closing overlap, and is at most ``OVERLAP + 1`` words long, so it is counted
once and whole.

A phrase is as frequent as wanted only if all its parts are. Lengths are
counted one after another; what was found frequent goes to the tasks as a bit
table of bounded size, which may let rare phrases through but stops no
frequent one. The counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm import bits
from scriptorium.llm.shared import freeing
from scriptorium.llm.textbytes import byte_class, combine, slices, split_words, utf8, word_array, word_hashes
from scriptorium.session import materialize

LONGEST = 4
OVERLAP, PERIOD = LONGEST - 1, 32
# without a trigger, a chunk ends after so many words
MOST_WORDS = 4096
BREAKS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
TEXT_WORD, CHUNK_WORD = byte_class(BREAKS + GAPS), byte_class(b" \n")
_IS_BREAK = ~byte_class(BREAKS)
# bytes of chunks that a task counts at a time
SLAB_BYTES = 8 << 20
# lengths that are counted together
PASSES = ((1,), (2,), (3, 4))


def parse_text(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Chunks of some texts, in order: the text of each, the chunk itself and
    whether it is its text's last. Words of a chunk stand apart by a space, or
    by a line feed where a piece ends between them; A-Z are folded."""
    w = split_words(buf, off, TEXT_WORD)
    n = len(w.start)
    if not n:
        return np.zeros(0, np.int64), [], np.zeros(0, bool)
    breaks = np.concatenate([[0], np.cumsum(_IS_BREAK[w.data])])
    doc = w.doc
    apart = np.append(breaks[w.start[1:]] > breaks[w.end[:-1]], False)
    h = combine([word_hashes(w.data, w.start, w.end)], tag=7)
    trigger = np.zeros(n, bool)
    if n >= OVERLAP:
        same = doc[OVERLAP - 1:] == doc[:n - OVERLAP + 1]
        window = combine([h[i:n - OVERLAP + 1 + i] for i in range(OVERLAP)])
        trigger[:n - OVERLAP + 1] = same & (window % np.uint64(PERIOD) == 0)
    opens = trigger.copy()
    opens[w.first[:-1][np.diff(w.first) > 0]] = True
    start = np.flatnonzero(opens)
    more = (np.append(start[1:], n) - start - 1) // MOST_WORDS
    if more.any():
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        extra = np.repeat(start, more) + MOST_WORDS * step
        start = np.sort(np.concatenate([start, extra[extra + OVERLAP <= w.first[doc[extra] + 1]]]))
    last = np.append(doc[start[1:]] != doc[start[:-1]], True)
    end = np.where(last, w.first[doc[start] + 1], np.append(start[1:], 0) + OVERLAP)
    # all words with one separator behind each
    words = word_array(w)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[1:n + 1]
    spaced = np.insert(np.frombuffer(data, np.uint8)[:ends[-1]], ends, np.where(apart, ord("\n"), ord(" ")).astype(np.uint8)).tobytes()
    at = np.concatenate([[0], ends + np.arange(1, n + 1)])
    return doc[start], [spaced[s:e] for s, e in zip(at[start].tolist(), (at[end] - 1).tolist())], last


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in freeing(batches):
        buf, off = utf8(batch.column(1))
        for lo, hi in slices(off):
            doc, chunks, last = parse_text(buf, off[lo:hi + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc + lo)), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last)],
                names=["lang", "chunk", "last"])


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, chunk, last, n``: the different chunks of each language and how
    often each occurs. Null texts have none; a null language is ``und``."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunks = texts.where("text is not null").mapInArrow(_parse, "lang string, chunk string, last boolean")
    return chunks.groupBy("lang", "chunk", "last").agg(F.count("*").alias("n"))


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in freeing(batches):
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= SLAB_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _hashes(values: pa.Array) -> np.ndarray:
    buf, off = utf8(values)
    return word_hashes(buf, off[:-1], off[1:], fold_case=False)


class Grams:
    """Phrases at the words of a slab of chunks: for each length, a number at
    every place where one that may be frequent starts (-1 elsewhere)."""

    def __init__(self, table: pa.Table):
        chunks, lang = (pa.concat_arrays(table[c].chunks) for c in ("chunk", "lang"))
        buf, off = utf8(chunks)
        w = split_words(buf, off, CHUNK_WORD)
        coded, langs = word_array(w, fold_case=False).dictionary_encode(), lang.dictionary_encode()
        chunk = w.doc
        self.langs, self.words = langs.dictionary, coded.dictionary.cast(pa.large_string())
        many = max(1, len(self.words))
        key, at = np.unique(langs.indices.to_numpy()[chunk].astype(np.int64) * many + coded.indices.to_numpy(), return_inverse=True)
        self.lang, self.word = key // many, key % many
        behind = w.first[1:][chunk] - np.arange(len(chunk))
        own = (behind > OVERLAP) | table["last"].to_numpy()[chunk]
        self.weight = np.where(own, table["n"].to_numpy()[chunk], 0)
        # a phrase goes on from a word to the next one of its piece
        self.on = (behind > 1) & (w.data[w.end] == ord(" ")) if len(chunk) else np.zeros(0, bool)
        self.at = {1: at}
        self.parts = {1: key[:, None] * 0 + np.arange(len(key))[:, None]}
        self.hash = {1: combine([_hashes(self.langs)[self.lang], _hashes(self.words)[self.word]])}

    def keep(self, length: int, table: np.ndarray) -> None:
        """Forget the phrases that ``table`` says are rare."""
        ok = bits.held(table, self.hash[length])
        at = self.at[length]
        self.at[length] = np.where((at >= 0) & ok[at], at, -1)

    def extend(self, length: int, known: int) -> None:
        """Number the phrases of ``length`` words all of whose parts of
        ``known`` words are left; those one word shorter are numbered."""
        n = len(self.on)
        places = np.ones(max(0, n - length + 1), bool)
        for i in range(length - 1):
            places &= self.on[i:i + len(places)]
        for i in range(length - known + 1):
            places &= self.at[known][i:i + len(places)] >= 0
        place = np.flatnonzero(places)
        head, tail = self.at[length - 1][place], self.at[1][place + length - 1]
        key, at = np.unique(head * len(self.word) + tail, return_inverse=True)
        self.at[length] = np.full(n, -1)
        self.at[length][place] = at
        head, tail = key // max(1, len(self.word)), key % max(1, len(self.word))
        self.parts[length] = np.concatenate([self.parts[length - 1][head], tail[:, None]], axis=1)
        self.hash[length] = combine([self.hash[length - 1][head], self.hash[1][tail]], tag=length)

    def counts(self, length: int) -> pa.RecordBatch:
        """``lang, phrase, n, h`` of the numbered phrases that start here."""
        at = self.at[length]
        place = np.flatnonzero(at >= 0)
        n = np.bincount(at[place], self.weight[place], len(self.parts[length])).astype(np.int64)
        some = np.flatnonzero(n)
        parts = self.parts[length][some]
        words = [self.words.take(pa.array(self.word[parts[:, i]])) for i in range(length)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if length > 1 else words[0]
        return _counted(self.langs.take(pa.array(self.lang[parts[:, 0]])), phrase.cast(pa.string()), n[some], self.hash[length][some])

    def totals(self) -> pa.RecordBatch:
        """All words of each language, as the count of the empty phrase."""
        n = np.bincount(self.lang[self.at[1]], self.weight, len(self.langs)).astype(np.int64)
        return _counted(self.langs, pa.array([""] * len(n)), n, np.zeros(len(n), np.uint64))


def _counted(lang: pa.Array, phrase: pa.Array, n: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(n), pa.array(h.view(np.int64))], names=["lang", "phrase", "n", "h"])


def _count(lengths: tuple[int, ...], tables: list[tuple[int, bits.Table]]):
    """Counts of phrases of these lengths; ``tables`` has the bit tables of
    shorter ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches):
            grams = Grams(slab)
            if lengths == (1,):
                yield grams.totals()
                yield grams.counts(1)
                continue
            known = 0
            for length, table in tables:
                if length > 1:
                    grams.extend(length, known)
                grams.keep(length, bits.load(table))
                known = length
            for length in lengths:
                grams.extend(length, known)
                yield grams.counts(length)

    return run


def phrase_counts(chunks: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n`` of all phrases of 1 to ``LONGEST`` words with at
    least ``least`` occurrences; the empty phrase has a language's words."""
    tables: list[tuple[int, bits.Table]] = []
    out = None
    for lengths in PASSES:
        rows = chunks.mapInArrow(_count(lengths, list(tables)), "lang string, phrase string, n long, h long")
        counts = materialize(
            rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.max("h").alias("h"))
            .where((F.col("n") >= least) | (F.col("phrase") == "")), "phrase-counts")
        tables.append((lengths[-1], bits.write(counts.where("phrase <> ''").select("h"))))
        out = counts if out is None else out.unionByName(counts)
    return out.select("lang", "phrase", "n")


def _joined(words: str, start, length) -> F.Column:
    return F.array_join(F.slice(F.col(words), start, length), " ")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, percent: int = 80,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to
    ``LONGEST`` words of each language.

    ``a`` is the phrase's count (at least ``least``), ``l`` and ``r`` those of
    its two parts at the cut that scores lowest (the first of equal ones),
    ``score`` is ``2000000 * a // (l + r)``. A phrase inside a longer one with
    at least ``percent`` of its count is left out. Ranks go by score, count
    (descending) and phrase (ascending bytes).

    Null texts have no phrases; a null language is ``und``; repeated rows
    count each; other columns are ignored; an empty table gives no rows.
    """
    chunks = materialize(dictionary(docs, lang_col, text_col), "phrase-dictionary")
    counts = materialize(phrase_counts(chunks, least).withColumn("words", F.split("phrase", " ")), "phrases")
    some = counts.where("phrase <> '' and size(words) > 1").withColumnRenamed("n", "a")
    count = counts.select("lang", "phrase", "n")
    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = (
        cuts.withColumn("head", _joined("words", F.lit(1), F.col("k")))
        .withColumn("rest", _joined("words", F.col("k") + 1, F.size("words") - F.col("k")))
        .join(count.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
        .join(count.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    )
    score = F.expr("(cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = (
        cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inside = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1), lambda s: F.array_join(F.slice(F.col("words"), s, m), " "))))
    longer = (
        some.where(F.size("words") > 2).select("lang", F.explode(inside).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    left = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.expr("cast(longer as decimal(20, 0)) * 100") < F.expr(f"cast(a as decimal(20, 0)) * {percent}")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # two levels, so that no task gets all phrases of a language
    first = (
        left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    )
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = count.where("phrase = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
