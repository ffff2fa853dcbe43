"""Ranked lexical search for many queries at once.

Queries ("items") share terms. In a block of items, the terms that occur in
the same items form one shared term set; pairs of sets that items have in
common are then joined, the commonest first, into a graph whose nodes are
shared sub-sums. For some documents at a time, the accumulator of every node
is computed once, children before parents, and an item's scores are the sum of
the few nodes that are left of it. All sums are integers, so sharing changes
no score.

Items are dealt into blocks of bounded size, planned in tasks and stored in
the shared folder; documents are read twice (statistics, scores), a task holds
the best documents of each item so far, and no join over documents is made.
"""

from __future__ import annotations

import functools
import heapq
import math
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import freeing, qualified, read_bytes, write_bytes
from scriptorium.llm.textbytes import byte_class, slices, split_words, utf8, word_array
from scriptorium.session import materialize, scratch_path

TERM_BYTES = byte_class(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# terms (with repeats between items) of a block of items, about
BLOCK_TERMS = 1 << 14
# pairs are mined among so many of an item's most shared sets; this bounds the work on the plan, not the result
PAIR_WIDTH = 96
# numbers in the accumulators of one step
CELLS = 1 << 22


def terms_of(text: str | Column) -> Column:
    """The different terms of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 1))


@dataclass
class Plan:
    """A block of items: terms with the leaf that each belongs to, joined
    nodes by level, and the nodes that make up each item."""

    block: int
    terms: list[str]
    leaf: np.ndarray
    leaves: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    nodes: int
    item_nodes: np.ndarray
    item_first: np.ndarray
    rows: np.ndarray
    item_ids: list[int | None]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def additions(self) -> tuple[int, int]:
        """Column additions that a document takes: shared, and item by item."""
        of_leaf = np.bincount(self.leaf, minlength=self.leaves)
        size = np.zeros(self.nodes, np.int64)
        size[:self.leaves] = of_leaf
        for parent, a, b in self.levels:
            size[parent] = size[a] + size[b]
        apart = np.add.reduceat(size[self.item_nodes], self.item_first[:-1]) - 1 if len(self.rows) else np.zeros(0)
        return int((of_leaf - 1).sum() + self.nodes - self.leaves + (np.diff(self.item_first) - 1).sum()), int(apart.sum())


def mine(sets: list[list[str]]) -> tuple[list[str], np.ndarray, int, list[tuple[int, int]], list[list[int]]]:
    """Shared sums of term sets (none empty): the terms, the leaf of each, the
    number of leaves, the children of every joined node (numbered behind the
    leaves, in order), and the nodes of each set.

    Terms of the same sets are one leaf. Then the pair of nodes that most sets
    hold is joined, until no pair is in two sets.
    """
    held = defaultdict(list)
    for i, terms in enumerate(sets):
        for t in terms:
            held[t].append(i)
    terms = sorted(held)
    number: dict[tuple, int] = {}
    leaf = np.array([number.setdefault(tuple(held[t]), len(number)) for t in terms], np.int64)
    owners = list(number)
    nodes: list[set[int]] = [set() for _ in sets]
    for n, own in enumerate(owners):
        for i in own:
            nodes[i].add(n)
    rate = {n: len(own) for n, own in enumerate(owners)}
    live = [set(sorted((n for n in own if rate[n] > 1), key=lambda n: (-rate[n], n))[:PAIR_WIDTH]) for own in nodes]
    pairs: Counter = Counter()
    where = defaultdict(set)
    for i, own in enumerate(live):
        for n in own:
            where[n].add(i)
        ordered = sorted(own)
        pairs.update((a, b) for x, a in enumerate(ordered) for b in ordered[x + 1:])
    heap = [(-c, p) for p, c in pairs.items() if c > 1]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while heap:
        count, (a, b) = heapq.heappop(heap)
        if pairs.get((a, b), 0) != -count:
            continue
        new = len(owners) + len(children)
        children.append((a, b))
        changed = set()
        for i in sorted(where[a] & where[b]):
            own = live[i]
            own -= {a, b}
            where[a].discard(i)
            where[b].discard(i)
            for c in own:
                for old in (a, b):
                    p = (old, c) if old < c else (c, old)
                    pairs[p] -= 1
                    changed.add(p)
                pairs[c, new] += 1
                changed.add((c, new))
            own.add(new)
            where[new].add(i)
            nodes[i] -= {a, b}
            nodes[i].add(new)
        del pairs[a, b]
        for p in sorted(changed):
            if pairs[p] > 1:
                heapq.heappush(heap, (-pairs[p], p))
            elif not pairs[p]:
                del pairs[p]
    return terms, leaf, len(owners), children, [sorted(own) for own in nodes]


def make_plan(block: int, rows: list[int], item_ids: list[int | None], sets: list[list[str]]) -> Plan:
    terms, leaf, leaves, children, nodes = mine(sets)
    depth = [0] * leaves
    for a, b in children:
        depth.append(1 + max(depth[a], depth[b]))
    levels = []
    for level in range(1, max(depth, default=0) + 1):
        these = [n for n in range(leaves, len(depth)) if depth[n] == level]
        pair = np.array([children[n - leaves] for n in these])
        levels.append((np.array(these), pair[:, 0], pair[:, 1]))
    first = np.concatenate([[0], np.cumsum([len(n) for n in nodes])]).astype(np.int64)
    return Plan(block, terms, leaf, leaves, levels, len(depth), np.array([n for own in nodes for n in own], np.int64),
                first, np.array(rows, np.int64), item_ids)


def _build(folder: str):
    def run(key, table):
        block, rows = key[0].as_py(), sorted(table.to_pylist(), key=lambda r: r["row"])
        plan = make_plan(block, [r["row"] for r in rows], [r["item_id"] for r in rows], [r["terms"] for r in rows])
        shared, apart = plan.additions()
        return pa.table({
            "block": [block], "file": [write_bytes(f"{folder}/block-{block:06d}", pickle.dumps(plan))],
            "items": [len(rows)], "terms": [len(plan.terms)], "nodes": [plan.nodes], "additions": [shared], "apart": [apart]})

    return run


PLANS = "block long, file string, items long, terms long, nodes long, additions long, apart long"


def plan_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Write the plans of all items; ``block, file, items, terms, nodes,
    additions, apart`` (additions a document takes with and without sharing).

    Items without a term have no plan. Every row is an item of its own, a
    repeated or null id too. A block holds about ``BLOCK_TERMS`` terms; an
    item is never divided.
    """
    spark = items.sparkSession
    rows = materialize(items.select(F.col(id_col).cast("long").alias("item_id"), terms_of(F.col(text_col).cast("string")).alias("terms"))
                       .where(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id()), "items")
    size = rows.agg(F.sum(F.size("terms").cast("long"))).first()[0] or 0
    block = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-size // BLOCK_TERMS))))
    folder = qualified(spark, scratch_path(spark, "plans"))
    return materialize(rows.withColumn("block", block).groupBy("block").applyInArrow(_build(folder), PLANS), "plan-files")


@functools.lru_cache(maxsize=4)
def _plan(file: str) -> tuple[Plan, pa.Array]:
    plan = pickle.loads(read_bytes(file))
    return plan, pa.array([t.encode() for t in plan.terms], pa.large_binary())


def _term_slices(column: pa.Array) -> list[tuple]:
    """Slices of whole documents: rows ``lo:hi``, words, the different words,
    and by word the number of its own."""
    buf, off = utf8(column)
    out = []
    for lo, hi in slices(off):
        w = split_words(buf, off[lo:hi + 1], TERM_BYTES)
        coded = word_array(w).dictionary_encode()
        out.append((lo, hi, w.first, coded.dictionary, coded.indices.to_numpy()))
    return out


def _occurrences(part: tuple, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of a plan's terms in a slice, by document."""
    lo, hi, first, words, index = part
    slot = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    term = slot[index]
    held = np.flatnonzero(term >= 0)
    doc = np.searchsorted(first, held, "right") - 1
    key, count = np.unique(doc * len(vocabulary) + term[held], return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), count


def _statistics(files: list[str]):
    """Per task: documents holding each term; block -1 has the documents with
    a term (term 0) and all their terms (term 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {f: None for f in files}
        docs = terms = 0
        for batch in freeing(batches):
            parts = _term_slices(batch.column(0))
            for lo, hi, first, _, index in parts:
                docs += int(np.count_nonzero(np.diff(first)))
                terms += len(index)
            for f in files:
                plan, vocabulary = _plan(f)
                count = np.zeros(len(plan.terms), np.int64) if held[f] is None else held[f]
                for part in parts:
                    count += np.bincount(_occurrences(part, vocabulary)[1], minlength=len(count))
                held[f] = count
        yield _rows(-1, np.array([0, 1]), np.array([docs, terms]))
        for f in files:
            if held[f] is not None:
                seen = np.flatnonzero(held[f])
                yield _rows(_plan(f)[0].block, seen, held[f][seen])

    return run


def _rows(block: int, term: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(term), block)), pa.array(term), pa.array(n)], names=["block", "term", "n"])


def _weigh(folder: str, docs: int):
    def run(key, table):
        plan, _ = _plan(table["file"][0].as_py())
        df = np.zeros(len(plan.terms), np.int64)
        seen = table.filter(pc.is_valid(table["term"]))
        df[seen["term"].to_numpy()] = seen["n"].to_numpy()
        plan.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
        return pa.table({"file": [write_bytes(f"{folder}/weighed-{plan.block:06d}", pickle.dumps(plan))]})

    return run


def _lengths(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A document's m."""
    if 90 * int(n.max(initial=0)) * docs < 1 << 63:
        return 10 + 90 * n * docs // max(terms, 1)
    return np.array([10 + 90 * x * docs // terms for x in n.tolist()], np.int64)


class Best:
    """The ``k`` best documents of each item of a block, so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least, self.pending = k, np.ones(items, np.int64), 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        if len(item):
            self.parts.append((item, scores[item, doc], ids[doc], null[doc]))
            self.pending += len(item)
            if self.pending > 4 * self.k * len(self.least) + 10_000:
                self.close()

    def close(self) -> tuple[np.ndarray, ...]:
        """``item, score, id, null``; ties go to null ids, then to smaller ones."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        item, score, ids, null = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((ids, ~null, -score, item))
        item, score, ids, null = item[order], score[order], ids[order], null[order]
        at = np.arange(len(item)) - np.searchsorted(item, item)
        kept = at < self.k
        full = at == self.k - 1
        self.least[item[full]] = np.maximum(score[full], 1)
        out = item[kept], score[kept], ids[kept], null[kept]
        self.parts, self.pending = [out], int(kept.sum())
        return out


def _scored(plan: Plan, part: tuple, vocabulary: pa.Array, m: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Scores (items x documents) of some documents at a time, from the first."""
    doc, term, tf = _occurrences(part, vocabulary)
    value = plan.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    docs, step = part[1] - part[0], max(1, CELLS // max(plan.nodes, len(plan.item_nodes), 1))
    for lo in range(0, docs, step):
        n = min(step, docs - lo)
        a, b = np.searchsorted(doc, [lo, lo + n])
        if a == b:
            continue
        sums = np.zeros((plan.nodes, n), np.int64)
        np.add.at(sums, (plan.leaf[term[a:b]], doc[a:b] - lo), value[a:b])
        for parent, x, y in plan.levels:
            sums[parent] = sums[x] + sums[y]
        yield lo, np.add.reduceat(sums[plan.item_nodes], plan.item_first[:-1], axis=0)


def _top(files: list[str], docs: int, terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, Best] = {}
        for batch in freeing(batches):
            parts = _term_slices(batch.column(1))
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            for f in files:
                plan, vocabulary = _plan(f)
                held = best.setdefault(f, Best(len(plan.rows), k))
                for part in parts:
                    m = _lengths(np.diff(part[2]), docs, terms)
                    for lo, scores in _scored(plan, part, vocabulary, m):
                        at = slice(part[0] + lo, part[0] + lo + scores.shape[1])
                        held.add(scores, ids[at], null[at])
        for f, held in best.items():
            plan, _ = _plan(f)
            item, score, found, missing = held.close()
            names = pa.array(plan.item_ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(plan.rows[item]), names.take(pa.array(item)), pa.array(found, mask=missing), pa.array(score)],
                names=["row", "item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every
    item, by descending score (above 0), equal scores by ascending id.

    Null texts have no terms. Every row of ``items`` is an item and every row
    of ``docs`` a document, so repeated ids and texts are listed each; null
    ids come before others of the same score. Items without a matching
    document, and empty tables, give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    plans = plan_items(items)
    # one path a block: the blocks' number follows the items', their content stays in tasks
    files = [r["file"] for r in plans.select("file").orderBy("block").collect()]
    seen = materialize(docs.select("text").mapInArrow(_statistics(files), "block long, term long, n long")
                       .groupBy("block", "term").agg(F.sum("n").alias("n")), "term-statistics")
    total = {r["term"]: r["n"] for r in seen.where("block = -1").collect()}
    n_docs, n_terms = total.get(0, 0), total.get(1, 0)
    folder = qualified(spark, scratch_path(spark, "weighed-plans"))
    weighed = materialize(plans.select("block", "file").join(seen, "block", "left").groupBy("block")
                          .applyInArrow(_weigh(folder, n_docs), "file string"), "weighed-files")
    files = sorted(r["file"] for r in weighed.collect())
    found = docs.mapInArrow(_top(files, n_docs, n_terms, k), "row long, item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # two levels, so that no task gets what every task has found for an item
    some = (
        found.withColumn("salt", F.spark_partition_id() % 64)
        .withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*order))).where(F.col("rank") <= k)
    )
    return (
        some.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order)))
        .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )
