"""Toxicity of whole texts behind leetspeak, spacing and repetition.

A character language model (trigrams over the letters a-z, word ends and one
class of other letters) is counted over all texts. A suspicious token (digits
or signs beside letters, a letter three times or more) or run of characters
set apart is a lattice: every character may stand for itself, for the letters
it imitates, for a repetition of the letter before, or for nothing; a gap
between characters set apart may stand for nothing or for the end of a word.
Viterbi decoding under the language model picks the restored words.

Restored texts are scored by a logistic model over the words and word
beginnings they hold. Features are hashed; those that tell the two labels
apart best (a likelihood-ratio test) enter the model. Features are chosen and
weights fitted on a bounded sample of the labelled texts.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.features import prefix_buckets, sigmoid
from scriptorium.llm.shared import freeing, qualified, read_bytes, sole, write_bytes
from scriptorium.llm.textbytes import Words, byte_class, slices, split_words, utf8
from scriptorium.session import materialize, scratch_path

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
FEATURES = 1024
# a feature needs this log likelihood ratio: a chance of 1e-4 without any tie to the label
LEAST_GAIN = 7.57
# the classifier is fitted on this many labelled rows
SAMPLE_DOCS = 50_000
STEPS, RATE, DECAY = 500, 0.5, 1e-5
CACHE_TOKENS = 100_000

LETTERS = byte_class(bytes(b for b in range(128) if not chr(b).isalpha()))
SYMBOLS = 28  # word end, a-z, other letters
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27

# Signs and the letters they imitate (fixed values).
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
# costs of the noisy channel, in nats
IMITATED, REPEATED, DROPPED, KEPT_SIGN = 1.0, 0.7, 1.0, 5.0
# signs that are no punctuation rarely stand for nothing; a gap wider than others rarely joins letters;
# a letter twice is mostly meant where none is there three times; a narrow gap rarely ends a word
DROPPED_FIRM, JOINED_WIDE, REPEATED_ONCE, ENDED = 5.0, 1.5, 3.0, 4.0
FIRM = "@$+€£"

_L, _S, _D = r"[^\W\d_]", r"[0-9@$!|+(<€£]", r"[@$!|+(<€£]"
_SIGN = re.compile(rf"{_S}(?={_L})|{_L}(?={_S})|{_D}(?={_S})|{_S}(?={_D})|({_L})\1\1")
# a gap is of ASCII, Latin-1 or general punctuation, as _suspicious knows it
_GAP = r"(?:[^\w@$!|+(<€£\u00c0-\u1fff\u2070-\U0010ffff]|_)+"
_APART = re.compile(rf"(?<![^\W_])(?:{_L}|{_S})(?![^\W_])(?:{_GAP}(?:{_L}|{_S})(?![^\W_])){{2,}}")
_GAPS = re.compile(_GAP)
_LETTER = re.compile(_L)
_STRETCHED = re.compile(r"(.)\1\1", re.S)
_CORE = re.compile(r"([^\w@$!|+(<€£]*)(.*?)([^\w@$!|+(<€£]*)", re.S)
_NUMBER = re.compile(r"[^\w@]*\d{2,}(?:[.,:/\-]\d+)*[^\w@]*")
_TOKENS = re.compile(r"\s+|\S+")
_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[65:91] = _LETTER_BYTE[97:123] = _LETTER_BYTE[128:] = True
_SIGN_BYTE = np.zeros(256, bool)
_SIGN_BYTE[list(b"0123456789@$!|+(<")] = True
_DIGIT_BYTE = np.zeros(256, bool)
_DIGIT_BYTE[list(b"0123456789")] = True


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


class Channel:
    """Viterbi decoding of suspicious tokens under trigram ``counts``."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        one = tri.sum((0, 1)) + 1
        one /= one.sum()
        two = tri.sum(0)
        two = (two + 10 * one) / (two.sum(1, keepdims=True) + 10)
        three = (tri + 10 * two[None]) / (tri.sum(2, keepdims=True) + 10)
        self.cost = (-np.log(three)).tolist()
        self._known: dict[str, str] = {}

    def word(self, token: str) -> str:
        """The restored form of a token."""
        return self._restored(token, tuple(token))

    def words(self, run: str) -> str:
        """The restored words of a run of characters set apart."""
        gaps = [m.span() for m in _GAPS.finditer(run)]
        narrow = min((hi - lo for lo, hi in gaps), default=0)
        steps, at = [], 0
        for lo, hi in gaps:
            steps += [run[at:lo], " " if hi - lo == narrow else "  "]
            at = hi
        return self._restored(" " + run, (*steps, run[at:]))

    def _restored(self, key: str, steps: tuple[str, ...]) -> str:
        if key not in self._known:
            if len(self._known) >= CACHE_TOKENS:
                self._known.clear()
            self._known[key] = self._decode(steps)
        return self._known[key]

    def _decode(self, steps: tuple[str, ...]) -> str:
        # a step is a character, or a narrow (one space) or wide gap (two); a
        # state is the last two symbols and the last letter; a path is a chain
        # of (letter, path before), so that a long token stays linear
        cost, best = self.cost, {(0, 0, ""): (0.0, None)}
        whole = "".join(steps)
        plain = " " in whole or not re.search(_S, whole.strip("@$!|+(<€£"))
        repeated = REPEATED_ONCE if plain and not _STRETCHED.search(whole.replace(" ", "")) else REPEATED
        for c in steps:
            new: dict = {}

            def offer(state, total, path):
                if state not in new or total < new[state][0]:
                    new[state] = (total, path)

            letter, gap = c.isalpha(), c.isspace()
            for (a, b, last), (total, path) in best.items():
                row = cost[a][b]
                if gap:
                    if b:
                        offer((a, b, last), total + (JOINED_WIDE if len(c) > 1 else 0), path)
                        offer((b, 0, ""), total + row[0] + (0 if len(c) > 1 else ENDED), (" ", path))
                    else:
                        offer((a, b, last), total, (" ", path) if path else path)
                    continue
                if letter:
                    s = _symbol(c)
                    offer((b, s, c), total + row[s], (c, path))
                    if c == last:
                        offer((a, b, last), total + repeated, path)
                    continue
                for x in IMITATES.get(c, ""):
                    s = _symbol(x)
                    offer((b, s, x), total + row[s] + IMITATED, (x, path))
                    if x == last:
                        offer((a, b, last), total + IMITATED + repeated, path)
                if not c.isdigit():
                    offer((a, b, last), total + (DROPPED_FIRM if c in FIRM else DROPPED), path)
                offer((b, 0, ""), total + row[0] + KEPT_SIGN, (c, path))
            best = new
        ends = [(total + (cost[a][b][0] if b else 0), path) for (a, b, _), (total, path) in best.items()]
        path, out = min(ends, key=lambda e: e[0])[1], []
        while path is not None:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def text(self, text: str) -> str:
        """``text`` in lower case with its suspicious tokens restored."""
        text = _APART.sub(lambda m: self.words(m[0]) if _LETTER.search(m[0]) else m[0], text.lower())
        if not _SIGN.search(text):
            return text
        return "".join(self._token(t) if _SIGN.search(t) else t for t in _TOKENS.findall(text))

    def _token(self, token: str) -> str:
        # numbers and bare punctuation are no words
        if not _LETTER.search(token) and (
                _NUMBER.fullmatch(token) or len(token) < 3 or not any(c in FIRM for c in token)):
            return token
        before, core, after = _CORE.fullmatch(token).groups()
        return before + self.word(core) + after


def _suspicious(data: np.ndarray) -> np.ndarray:
    """Places in ``data`` where a text may need restoring, all that ``_SIGN``
    and ``_APART`` can match: signs beside letters or signs, a letter three
    times, three characters in a row that each stand alone."""
    letter, sign, digit = _LETTER_BYTE[data], _SIGN_BYTE[data], _DIGIT_BYTE[data]
    out = np.zeros(len(data), bool)
    if len(data) < 3:
        out[:] = True
        return out
    # characters of two and three bytes that are no letters: Latin-1 signs but for its three letters, punctuation
    at = np.flatnonzero(data[:-1] == 0xC2)
    at = at[~np.isin(data[at + 1], (0xAA, 0xB5, 0xBA))]
    letter[at] = letter[at + 1] = False
    pound = at[data[at + 1] == 0xA3]
    sign[pound] = sign[pound + 1] = True
    at = np.flatnonzero(data[:-2] == 0xE2)
    euro = at[(data[at + 1] == 0x82) & (data[at + 2] == 0xAC)]
    other = at[(data[at + 1] == 0x80) | ((data[at + 1] == 0x81) & (data[at + 2] < 0xB0))]
    for k in range(3):
        letter[euro + k] = letter[other + k] = False
        sign[euro + k] = True
    head = (data & 0xC0) != 0x80
    held = letter | sign
    out[:-1] = head[1:] & held[:-1] & held[1:] & (sign[:-1] | sign[1:]) & ~(digit[:-1] & digit[1:])
    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    # letters of two bytes repeat with period 2, and so on; upper and lower case may differ in any byte but the first
    out[:-2] |= letter[:-2] & (folded[:-2] == folded[1:-1]) & (folded[1:-1] == folded[2:])
    for n in (2, 3, 4):
        if len(data) >= 3 * n:
            last = len(data) - 2 * n
            out[:last] |= letter[:last] & (data[:last] >= 192) & (data[:last] == data[n:last + n]) & (data[:last] == data[2 * n:])
    edge = np.diff(np.concatenate([[False], held, [False]]).astype(np.int8))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    heads = np.concatenate([[0], np.cumsum(head)])
    alone, lettered = heads[end] - heads[first] == 1, letter[first]
    three = alone[:-2] & alone[1:-1] & alone[2:] & (lettered[:-2] | lettered[1:-1] | lettered[2:])
    out[first[:-2][three]] = True
    return out


def restored_slices(column: pa.Array, channel: Channel) -> Iterator[tuple[int, int, Words]]:
    """By slices of rows ``lo:hi``: the words of the restored texts."""
    buf, off = utf8(column)
    raw = memoryview(buf)
    for lo, hi in slices(off):
        base = off[lo]
        flags = np.concatenate([[0], np.cumsum(_suspicious(buf[base:off[hi]]))])
        local = off[lo:hi + 1] - base
        marked = np.flatnonzero(flags[local[1:]] > flags[local[:-1]])
        if not len(marked):
            yield lo, hi, split_words(buf, off[lo:hi + 1], LETTERS)
            continue
        texts = [bytes(raw[off[i]:off[i + 1]]) for i in range(lo, hi)]
        for i in marked.tolist():
            texts[i] = channel.text(texts[i].decode()).encode()
        data = np.frombuffer(b"".join(texts), np.uint8)
        yield lo, hi, split_words(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), LETTERS)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for batch in freeing(batches):
        buf, off = utf8(batch.column(0))
        for lo, hi in slices(off):
            c = _CLASS[np.insert(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], 0)]
            trigrams = c[:-2] * SYMBOLS ** 2 + c[1:-1] * SYMBOLS + c[2:]
            # the space between words is one word end, however wide
            total += np.bincount(trigrams[(c[1:-1] > 0) | (c[2:] > 0)], minlength=len(total))
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["trigram", "n"])


def character_model(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over all texts; at most 28^3 of them, whatever the data."""
    rows = (
        texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_trigrams, "trigram long, n long")
        .groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    for trigram, n in rows:
        counts[trigram] = n
    return counts


@dataclass
class Model:
    """Feature slots (-1: not in the model), weights, intercept, trigrams."""

    trigrams: np.ndarray
    slot: np.ndarray
    weights: np.ndarray
    intercept: float


def _load_channel(uri: str) -> Channel:
    return Channel(pickle.loads(read_bytes(uri)))


def _channel(uri: str) -> Channel:
    return sole(_load_channel, uri)


def _load_model(uri: str) -> tuple[Model, Channel]:
    model = pickle.loads(read_bytes(uri))
    return model, Channel(model.trigrams)


def _model(uri: str) -> tuple[Model, Channel]:
    return sole(_load_model, uri)


def _count_features(trigrams: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in freeing(batches):
            label = (batch.column(1).to_numpy(zero_copy_only=False) > 0).astype(np.int64)
            for lo, hi, words in restored_slices(batch.column(0), _channel(trigrams)):
                doc, feature = prefix_buckets(words, PREFIXES, BUCKETS)
                once = np.unique(doc * BUCKETS + feature)
                own = label[lo:hi]
                for y in (0, 1):
                    totals[y, :-1] += np.bincount(once[own[once // BUCKETS] == y] % BUCKETS, minlength=BUCKETS)
                    totals[y, -1] += np.count_nonzero(own == y)
        held = np.flatnonzero(totals.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(totals[0, held]), pa.array(totals[1, held])], names=["feature", "clean", "toxic"])

    return run


def telling_features(counts: DataFrame) -> list[int]:
    """Up to ``FEATURES`` features whose presence tells the labels apart best,
    by the likelihood ratio; the total is feature ``BUCKETS``."""
    total = counts.where(F.col("feature") == BUCKETS).agg(
        F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n = float(sum(total))

    def part(have, of_label, have_feature):
        return F.when(have > 0, have * F.log(have * n / (of_label * have_feature))).otherwise(0.0)

    c, t = F.col("clean").cast("double"), F.col("toxic").cast("double")
    no_c, no_t = total[0] - c, total[1] - t
    gain = (part(c, F.lit(float(total[0])), c + t) + part(t, F.lit(float(total[1])), c + t)
            + part(no_c, F.lit(float(total[0])), no_c + no_t) + part(no_t, F.lit(float(total[1])), no_c + no_t))
    rows = (
        counts.where(F.col("feature") < BUCKETS).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    )
    return [r["feature"] for r in rows]


def _vectors(slot_uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, slot = pickle.loads(read_bytes(slot_uri))
        channel = Channel(trigrams)
        for batch in freeing(batches):
            label = (batch.column(1).to_numpy(zero_copy_only=False) > 0).astype(np.int8)
            for lo, hi, words in restored_slices(batch.column(0), channel):
                doc, at = _present(words, slot)
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(label[lo:hi]), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(at.astype(np.int16))),
                    batch.column(2).slice(lo, hi - lo),
                ], names=["label", "features", "h"])

    return run


def _present(words: Words, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, model feature) pairs, each once, by document."""
    doc, feature = prefix_buckets(words, PREFIXES, BUCKETS)
    at = slot[feature]
    held = np.flatnonzero(at >= 0)
    once = np.unique(doc[held] * FEATURES + at[held])
    return once // FEATURES, once % FEATURES


def fit_logistic(label: np.ndarray, doc: np.ndarray, feature: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and intercept over 0/1 features, by AdaGrad on the whole sample.
    The rarer label weighs more, by the square root of the ratio."""
    n = len(label)
    odds = (label.sum() + 1) / (n - label.sum() + 1)
    weigh = np.where(label > 0, odds ** -0.25, odds ** 0.25)
    weigh /= weigh.sum() or 1
    weights, intercept = np.zeros(width), float(np.log(odds) / 2)
    squares, square = np.full(width, 1e-8), 1e-8
    for _ in range(STEPS if n else 0):
        error = (sigmoid(np.bincount(doc, weights[feature], n) + intercept) - label) * weigh
        slope = np.bincount(feature, error[doc], width) + DECAY * weights
        squares += slope ** 2
        square += error.sum() ** 2
        weights -= RATE * slope / np.sqrt(squares)
        intercept -= RATE * error.sum() / np.sqrt(square)
    return weights, intercept


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> str:
    """Fit a model and store it in the shared folder; returns its path.

    The character model is counted over all of ``docs``; features are chosen
    and weights fitted on ``SAMPLE_DOCS`` labelled texts, chosen by a hash of
    the id (weights on as many rows, if ids repeat, by a hash of the text).
    Rows of ``labels`` with a null id or label take
    no part. Without labels every text has the score 0.5.
    """
    spark = docs.sparkSession
    folder = qualified(spark, scratch_path(spark, "toxicity"))
    trigrams = character_model(docs, text_col)
    channel = write_bytes(f"{folder}/trigrams", pickle.dumps(trigrams))
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where("doc_id is not null and label is not null").distinct()
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = materialize(
        known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(SAMPLE_DOCS), "toxicity-sample")
    # at most SAMPLE_DOCS short rows: the texts stay where they are
    labelled = texts.join(F.broadcast(some), "doc_id").select("text", "label", F.xxhash64("doc_id", "text").alias("h"))
    counts = materialize(
        labelled.mapInArrow(_count_features(channel), "feature long, clean long, toxic long"), "toxicity-counts")
    chosen = telling_features(counts)
    slot = np.full(BUCKETS, -1, np.int64)
    slot[chosen] = np.arange(len(chosen))
    selection = write_bytes(f"{folder}/features", pickle.dumps((trigrams, slot)))
    sample = labelled.mapInArrow(_vectors(selection), "label byte, features array<smallint>, h long") \
        .orderBy("h", "label").limit(SAMPLE_DOCS).toArrow().combine_chunks()
    label = sample["label"].to_numpy().astype(float)
    features = sample["features"].combine_chunks()
    if isinstance(features, pa.ChunkedArray):
        features = pa.concat_arrays(features.chunks) if features.num_chunks else pa.array([], pa.list_(pa.int16()))
    doc = np.repeat(np.arange(len(label)), features.value_lengths().to_numpy())
    weights, intercept = fit_logistic(label, doc, features.flatten().to_numpy().astype(np.int64), FEATURES)
    if not len(label):
        intercept = 0.0
    return write_bytes(f"{folder}/model", pickle.dumps(Model(trigrams, slot, weights, intercept)))


def _scores(column: pa.Array, model_uri: str) -> np.ndarray:
    model, channel = _model(model_uri)
    out = np.zeros(len(column))
    for lo, hi, words in restored_slices(column, channel):
        doc, at = _present(words, model.slot)
        out[lo:hi] = sigmoid(np.bincount(doc, model.weights[at], hi - lo) + model.intercept)
    return out


def _append_score(model_uri: str, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(text_at), model_uri))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: toxic likelier) of every row, from
    its text alone. Null and empty texts have no words and get the model's
    score for that; repeated rows are scored each; other columns are ignored;
    an empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_append_score(model, 1), "doc_id long, score double")


def remove_toxic(docs: DataFrame, model: str, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with a score below ``threshold``."""
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            yield batch.filter(pa.array(_scores(batch.column(text_at), model) < threshold))

    return docs.mapInArrow(run, docs.schema)


def restore(texts: list[str], trigrams: np.ndarray) -> list[str]:
    """Restored forms of some texts."""
    channel = Channel(trigrams)
    return [channel.text(t) for t in texts]
