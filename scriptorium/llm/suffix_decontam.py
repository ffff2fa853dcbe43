"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards (whole documents, about two megabytes),
numbers their words by the vocabulary of the benchmark (all other words are 0,
which no match can cross) and sorts the suffixes that are long enough to hold
a match. Every benchmark suffix is then binary-searched in the shard: the
range of suffixes that begin with its window gives all places of the window,
and the nearest benchmark suffixes of each place give the longest verbatim
match from there. Places turn into hit words, items and the longest match of
each document; documents with a hit can be removed.

Words are compared themselves, not by hashes. The benchmark is cut into blocks
of bounded size, built in tasks and stored in the shared folder; a worker holds
one block at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.shared import freeing, qualified, read_bytes, sole, write_bytes
from scriptorium.llm.textbytes import Words, byte_class, slices, split_words, utf8, word_array
from scriptorium.session import materialize, scratch_path

WORD_BYTES = byte_class(bytes(b for b in range(128) if not chr(b).isalnum()))
# a shard has about so many bytes; so many shards meet a block together if there are several
SHARD_BYTES, SHARDS = 2 << 20, 4
BLOCK_BYTES = 16 << 20
REPORT = ("doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, "
          "longest long, longest_item string, longest_at long")


def _packed(ids: np.ndarray, bits: int, per: int) -> np.ndarray:
    """``per`` word numbers from each place on, in one integer."""
    out = np.zeros(len(ids), np.int64)
    for r in range(per):
        out <<= bits
        out[:len(ids) - r] |= ids[r:]
    return out


def _at(packed: np.ndarray, place: np.ndarray) -> np.ndarray:
    return packed[np.minimum(place, len(packed) - 1)]


def sort_suffixes(packed: np.ndarray, places: np.ndarray, per: int, depth: int) -> np.ndarray:
    """``places`` in the order of their suffixes, told apart up to ``depth``
    words. Each round looks ``per`` words further, at ties only."""
    order = places[np.argsort(packed[places], kind="stable")]
    key = packed[order]
    starts = np.ones(len(order), bool)
    starts[1:] = key[1:] != key[:-1]
    for ahead in range(per, depth, per):
        group = np.cumsum(starts)
        tied = np.flatnonzero(np.bincount(group)[group] > 1) if len(order) else group
        if not len(tied):
            break
        group, key = group[tied], _at(packed, order[tied] + ahead)
        by = np.lexsort((key, group))
        order[tied], key = order[tied][by], key[by]
        starts[tied[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    return order


@dataclass
class Block:
    """Some benchmark items: vocabulary (the words themselves, numbered from
    1), word numbers with a 0 after each item, their sorted suffixes, and the distinct windows with the items they are in."""

    vocabulary: pa.Array
    bits: int
    per: int
    names: list[str]
    packed: np.ndarray
    item: np.ndarray
    left: np.ndarray
    suffixes: np.ndarray
    window_keys: np.ndarray
    window_words: np.ndarray
    in_item: np.ndarray
    in_first: np.ndarray


def make_block(names: list[str], texts: list[str], window: int) -> Block | None:
    """None if no item has a word."""
    buf, off = utf8(pa.array(texts, pa.string()))
    w = split_words(buf, off, WORD_BYTES)
    if not len(w.start):
        return None
    coded = word_array(w).dictionary_encode()
    vocabulary, number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    bits = max(1, int(len(vocabulary)).bit_length())
    per = 63 // bits
    n = np.diff(w.first)
    first = w.first + np.arange(len(w.first))  # one 0 after each item
    ids = np.zeros(first[-1] + per, np.int64)
    ids[np.arange(len(number)) + w.doc] = number + 1
    item = np.repeat(np.arange(len(n)), n + 1)
    left = np.repeat(first[1:] - 1, n + 1) - np.arange(len(item))
    packed = _packed(ids, bits, per)
    suffixes = sort_suffixes(packed, np.flatnonzero(left), per, int(n.max()))

    words = np.minimum(window, n)[item]
    at = np.flatnonzero((left >= words) & (left > 0))
    words = words[at]
    keys = [words]
    for ahead in range(0, window, per):
        keep = np.clip(words - ahead, 0, per)
        keys.append(_at(packed, at + ahead) >> (bits * (per - keep)))
    distinct, which = np.unique(np.stack(keys, 1), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), item[at]], 1), axis=0)
    return Block(
        vocabulary, bits, per, names, packed, item, left, suffixes,
        distinct[:, 1:], distinct[:, 0], pairs[:, 1],
        np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)))


def _search(packed: np.ndarray, order: np.ndarray, b: Block, beyond: bool) -> np.ndarray:
    """For every window the first suffix of ``order`` not below it, or, with
    ``beyond``, above it: one binary search for all windows together."""
    lo, hi = np.zeros(len(b.window_words), np.int64), np.full(len(b.window_words), len(order))
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        below = np.zeros(len(open_), bool)
        equal = np.ones(len(open_), bool)
        for j in range(b.window_keys.shape[1]):
            keep = np.clip(b.window_words[open_] - j * b.per, 0, b.per)
            ours = _at(packed, order[mid] + j * b.per) >> (b.bits * (b.per - keep))
            theirs = b.window_keys[open_, j]
            below |= equal & (ours < theirs)
            equal &= ours == theirs
        up = below | (equal & beyond)
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]
    return lo


def _common(a: np.ndarray, i: np.ndarray, b: Block, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes ``a[i]`` and ``b.packed[j]`` have in common,
    not past the end of the benchmark item."""
    out, on = np.zeros(len(i), np.int64), np.arange(len(i))
    limit = b.left[j]
    while len(on):
        x, y = _at(a, i[on] + out[on]), _at(b.packed, j[on] + out[on])
        same = np.full(len(on), b.per)
        for r in range(b.per):
            shift = b.bits * r
            same[(x >> shift) != (y >> shift)] = b.per - 1 - r
        out[on] += same
        on = on[(same == b.per) & (out[on] < limit[on])]
    return np.minimum(out, limit)


def _longest(packed: np.ndarray, left: np.ndarray, places: np.ndarray, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Longest verbatim match from each place and the benchmark place it has:
    the nearest benchmark suffixes below and above are the ones to compare."""
    lo, hi = np.zeros(len(places), np.int64), np.full(len(places), len(b.suffixes))
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        here, there = places[open_], b.suffixes[mid]
        same = _common(packed, here, b, there)
        ended = same >= b.left[there]  # the whole item suffix is a prefix of ours
        step = same // b.per * b.per
        up = ended | (_at(b.packed, there + step) < _at(packed, here + step))
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]
    best, where = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for near in (lo - 1, lo):
        there = b.suffixes[np.clip(near, 0, len(b.suffixes) - 1)]
        same = np.minimum(_common(packed, places, b, there), left[places])
        better = same > best
        best[better], where[better] = same[better], there[better]
    return best, where


def scan_shard(words: Words, coded: pa.DictionaryArray, b: Block) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Of the words of a shard, also as a dictionary of the different ones:
    hit words (bool), items by document, the longest match (length, item,
    word) of each document, and the documents that have one."""
    docs = len(words.first) - 1
    slot = pc.fill_null(pc.index_in(coded.dictionary, value_set=b.vocabulary), -1).to_numpy()
    number = slot.astype(np.int64)[coded.indices.to_numpy()] + 1
    place_of = np.arange(len(number)) + words.doc
    ids = np.zeros(len(number) + docs + b.per, np.int64)
    ids[place_of] = number
    breaks = np.flatnonzero(ids == 0)
    left = breaks[np.searchsorted(breaks, np.arange(len(ids)))] - np.arange(len(ids))
    hit = np.zeros(len(ids) + 1, np.int64)
    items = [np.empty(0, np.int64)] * docs
    longest = np.zeros((docs, 3), np.int64)
    places = np.flatnonzero(left >= b.window_words.min())
    if not len(places):
        return np.zeros(len(number), bool), items, longest, np.empty(0, np.int64)
    packed = _packed(ids, b.bits, b.per)
    order = sort_suffixes(packed, places, b.per, int(b.window_words.max()))
    lo, hi = _search(packed, order, b, False), _search(packed, order, b, True)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return np.zeros(len(number), bool), items, longest, found
    n = (hi - lo)[found]
    at = order[np.repeat(lo[found] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    window = np.repeat(found, n)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + b.window_words[window], -1)
    hit = np.cumsum(hit)[place_of] > 0

    doc_first = words.first + np.arange(docs + 1)
    doc = np.searchsorted(doc_first, at, "right") - 1
    pairs = np.unique(doc * len(b.window_words) + window)
    doc_of, window = np.divmod(pairs, len(b.window_words))
    size = np.diff(b.in_first)[window]
    chosen = np.repeat(b.in_first[window] - np.cumsum(size) + size, size) + np.arange(size.sum())
    pairs = np.unique(np.repeat(doc_of, size) * len(b.names) + b.in_item[chosen])
    doc_of, item = np.divmod(pairs, len(b.names))
    for d, own in zip(*_runs(doc_of, item)):
        items[d] = own

    at = np.unique(at)
    best, where = _longest(packed, left, at, b)
    doc = np.searchsorted(doc_first, at, "right") - 1
    first = np.lexsort((at, -best, doc))
    first = first[np.concatenate([[True], doc[first][1:] != doc[first][:-1]])]
    longest[doc[first]] = np.stack([best[first], b.item[where[first]], at[first] - doc_first[doc[first]]], 1)
    return hit, items, longest, np.unique(doc)


def _runs(group: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    cut = np.flatnonzero(np.diff(group)) + 1
    starts = np.concatenate([[0], cut]) if len(group) else cut
    return group[starts].tolist(), np.split(values, cut) if len(group) else []


def _load_block(uri: str) -> Block:
    return pickle.loads(read_bytes(uri))


def _block(uri: str) -> Block:
    return sole(_load_block, uri)


class Shard:
    """Words of some documents and what the blocks so far have found there."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.words = split_words(buf, off, WORD_BYTES)
        self.coded = word_array(self.words).dictionary_encode()
        self.hit = np.zeros(len(self.coded), bool)
        self.names: list[set] = [set() for _ in range(len(off) - 1)]
        self.longest: list[tuple] = [(0, None, None)] * (len(off) - 1)

    def scan(self, b: Block) -> None:
        more, items, best, docs = scan_shard(self.words, self.coded, b)
        self.hit |= more
        for d in docs.tolist():
            self.names[d].update(b.names[i] for i in items[d].tolist())
            length, item, at = best[d].tolist()
            # the first word of the longest matches, then the smallest item
            self.longest[d] = min(self.longest[d], (length, b.names[item], at), key=lambda x: (-x[0], x[2] or 0, x[1] or ""))

    def reports(self) -> Iterator[tuple]:
        """By document: (words, hit words, items, spans, longest match)."""
        words, names, hit = self.words, self.names, self.hit
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for d in range(len(names)):
            a, z = int(words.first[d]), int(words.first[d + 1])
            spans = []
            if names[d]:
                i, j = np.searchsorted(ends, a, "right"), np.searchsorted(starts, z)
                spans = [(max(s, a) - a, min(e, z) - a) for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist())]
            yield z - a, sum(e - s for s, e in spans), sorted(names[d]), spans, self.longest[d]


def _reports(column: pa.Array, uris: list[str]) -> Iterator[tuple]:
    """:meth:`Shard.reports` of all documents; some shards meet a block before
    the next block is read."""
    buf, off = utf8(column)
    for some in batched(slices(off, SHARD_BYTES), SHARDS if len(uris) > 1 else 1):
        shards = [Shard(buf, off[lo:hi + 1]) for lo, hi in some]
        for uri in uris:
            for shard in shards:
                shard.scan(_block(uri))
        for shard in shards:
            yield from shard.reports()


def _report(uris: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            rows = list(_reports(batch.column(1), uris))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.string())),
                pa.array([[{"start": s, "end": e} for s, e in r[3]] for r in rows],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([r[4][0] for r in rows], pa.int64()), pa.array([r[4][1] for r in rows], pa.string()),
                pa.array([r[4][2] for r in rows], pa.int64()),
            ], names=["doc_id", "n_words", "n_hit", "items", "spans", "longest", "longest_item", "longest_at"])

    return run


def _clean(uris: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            yield batch.filter(pa.array([not r[1] for r in _reports(batch.column(text_at), uris)], pa.bool_()))

    return run


def _build(folder: str, window: int):
    def run(key, table):
        block = key[0].as_py()
        rows = sorted(zip(table["item"].to_pylist(), table["text"].to_pylist()))
        made = make_block([r[0] for r in rows], [r[1] for r in rows], window)
        if made is None:
            return pa.table({"uri": pa.array([], pa.string())})
        return pa.table({"uri": [write_bytes(f"{folder}/{block:06d}", pickle.dumps(made, pickle.HIGHEST_PROTOCOL))]})

    return run


def _store_blocks(bench: DataFrame, window: int, item_col: str, text_col: str) -> list[str]:
    """Write the benchmark's blocks to the shared folder, each in a task; only
    their paths come back. An item is not divided, repeated rows are one."""
    spark = bench.sparkSession
    items = bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")) \
        .where("item is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    folder = qualified(spark, scratch_path(spark, "benchmark"))
    made = materialize(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
                       .groupBy("block").applyInArrow(_build(folder, window), "uri string"), "benchmark-blocks")
    return sorted(r["uri"] for r in made.collect())


def contamination(
    docs: DataFrame, bench: DataFrame, window: int = 10, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit`` (words inside a window
    of the benchmark), ``items`` (sorted ids as strings), ``spans`` of hit
    words, and the ``longest`` verbatim match with its item and first word.

    A window is ``window`` consecutive words of an item, or a shorter item as
    a whole. Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased. Null texts have no words; items without id or words take no
    part; rows with a null ``doc_id`` are reported like others; repeated rows
    are reported each. Ties for the longest match go to the first word. Other
    columns are ignored. An empty benchmark hits nothing.
    """
    uris = _store_blocks(bench, window, item_col, item_text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_report(uris), REPORT)


def remove_contaminated(
    docs: DataFrame, bench: DataFrame, window: int = 10, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no word in a window
    of the benchmark; see :func:`contamination`."""
    uris = _store_blocks(bench, window, item_col, item_text_col)
    return docs.mapInArrow(_clean(uris, docs.columns.index(text_col)), docs.schema)
