"""Near-duplicate documents by MinHash with tensored banding.

``halves`` short hashes of two minhash values each are computed per document,
and every *pair* of them is the key of one hash table: 16 halves (32 minhash
values) give 120 tables, which would otherwise need 480 values. At similarity
0.8 a pair of documents misses all tables with probability 2e-6.

Linking goes on from the tables in three exact steps, none of which writes
out the pairs of a group:

1. Equal shingle sets form classes; only the smallest id of a class goes on.
2. In every table each member is paired with its bucket's smallest id, one
   such partner per document is confirmed on the full sets, and confirmed
   links are contracted to components.
3. Where a bucket still spans components, a document stays open unless the
   sizes and the number of its shingles that no other open document has rule
   out every partner. Open documents meet again under single minhash values
   (8 of them; a pair at 0.8 misses all with probability 3e-6); each meeting
   is cut into cells of bounded size, and a cell compares its full sets in
   one task and returns a spanning forest of the links it found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.components import connected_components
from scriptorium.llm.shared import freeing
from scriptorium.llm.textbytes import byte_class, combine, mix, slices, split_words, utf8, word_hashes
from scriptorium.session import materialize

WORD_BYTES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
HALVES = 16
COARSE = 8
# below this similarity the tables would miss more than one pair in 10,000
LEAST_PERCENT = 70
# a cell of step 3 holds about this many documents and shingles of each side
CELL_ROWS, CELL_SHINGLES = 512, 1 << 19
# ids are looked up in a bitmap of fixed size before their texts are read again;
# their upper bits move them to other places, as numbers of rows differ there by partition
BITMAP_BITS, UPPER, SPREAD = 1 << 25, 33, 2_654_435_761

_rng = np.random.default_rng(4)
_FACTOR = _rng.integers(1, 1 << 63, 2 * HALVES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(1, 1 << 63, 2 * HALVES, dtype=np.uint64)


def shingle_sets(column: pa.Array, words_per_shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """By slices of rows ``lo:hi``: the sorted distinct shingle hashes of each
    text, joined, and where each text's set starts."""
    buf, off = utf8(column)
    k = words_per_shingle
    for lo, hi in slices(off):
        w = split_words(buf, off[lo:hi + 1], WORD_BYTES)
        h = word_hashes(w.data, w.start, w.end)
        full = combine([h[i:len(h) - k + 1 + i] for i in range(k)]) if len(h) >= k else h[:0]
        sets = []
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if b - a >= k:
                sets.append(np.unique(full[a:b - k + 1]))
            elif b > a:
                sets.append(combine([h[i:i + 1] for i in range(a, b)], tag=b - a))
            else:
                sets.append(h[:0])
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        yield lo, hi, np.concatenate(sets), first


def _signatures(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for lo, hi, joined, first in shingle_sets(batch.column(1), words_per_shingle):
                n = np.diff(first)
                held = np.flatnonzero(n)
                mins = np.zeros((2 * HALVES, hi - lo), np.uint64)
                whole = np.zeros((2, hi - lo), np.uint64)
                if len(held):
                    at = first[held]
                    for i in range(2 * HALVES):
                        mins[i, held] = np.minimum.reduceat(joined * _FACTOR[i] + _SHIFT[i], at)
                    whole[0, held] = np.add.reduceat(mix(joined), at)
                    whole[1, held] = np.bitwise_xor.reduceat(mix(joined ^ np.uint64(0x5851F42D4C957F2D)), at)
                halves = [combine([mins[2 * i], mins[2 * i + 1]], tag=i) for i in range(HALVES)]
                lists = lambda rows, k: pa.FixedSizeListArray.from_arrays(
                    pa.array(np.stack(rows, 1).reshape(-1).view(np.int64)), k).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                    pa.array(n.astype(np.int64)),
                    pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)),
                    lists(halves, HALVES), lists(list(mins[:2 * COARSE:2]), COARSE),
                ], names=["doc_id", "n_shingles", "h1", "h2", "halves", "coarse"])

    return run


def _sets(words_per_shingle: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bitmap.value, np.uint8)
        for batch in freeing(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            bit = (ids ^ (ids >> UPPER) * SPREAD) % BITMAP_BITS
            rows = np.flatnonzero(wanted[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            if not len(rows):
                continue
            batch = batch.take(pa.array(rows))
            for lo, hi, joined, first in shingle_sets(batch.column(1), words_per_shingle):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(joined.view(np.int64))),
                ], names=["doc_id", "shingles"])

    return run


def _bitmap(ids: DataFrame) -> bytes:
    """Bits of ``doc_id`` in ``BITMAP_BITS`` places: 4 MB, whatever the data."""
    upper = F.shiftright("doc_id", UPPER) * F.lit(SPREAD).cast("long")
    place = F.pmod(F.col("doc_id").bitwiseXOR(upper), F.lit(BITMAP_BITS)) + 1
    rows = (
        ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = bytearray(BITMAP_BITS // 8)
    for bucket, bits in rows:
        out[(bucket - 1) * len(bits):bucket * len(bits)] = bits
    return bytes(out)


def _confirm(percent: int):
    """Rows (u, v, a, b) whose sets ``a`` and ``b`` are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            sides = []
            for c in (2, 3):
                column = batch.column(c)
                sides.append((column.values.to_numpy(), column.offsets.to_numpy()))
            (a, at), (b, bt) = sides
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = a[at[i]:at[i + 1]], b[bt[i]:bt[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return run


def _cell_links(percent: int):
    """A spanning forest of the links between documents of one cell that are
    not in one component yet. The sets become 0/1 rows over the cell's shared
    shingles, multiplied a few thousand shingles at a time."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        ids, comp, side = (cell[c].to_numpy() for c in ("doc_id", "comp", "side"))
        shingles = cell["shingles"].combine_chunks()
        n = np.diff(shingles.offsets.to_numpy())
        flat, row = shingles.flatten().to_numpy(), np.repeat(np.arange(len(ids)), n)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        code, row = (np.cumsum(shared) - 1)[code[shared[code]]], row[shared[code]]
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        both = np.zeros((len(ids), len(ids)), np.float32)
        width = 4096
        for lo in range(0, int(shared.sum()), width):
            i, j = np.searchsorted(code, [lo, lo + width])
            ones = np.zeros((len(ids), width), np.float32)
            ones[row[i:j], code[i:j] - lo] = 1
            both += ones @ ones.T
        linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        linked &= comp[:, None] != comp[None, :]
        if side.min() != side.max():
            linked &= side[:, None] != side[None, :]
        u, v, seen = [], [], np.zeros(len(ids), bool)
        for i in np.flatnonzero(linked.any(1)):
            frontier = [] if seen[i] else [i]
            seen[i] = True
            while frontier:
                x = frontier.pop()
                new = np.flatnonzero(linked[x] & ~seen)
                seen[new] = True
                u.extend([ids[x]] * len(new))
                v.extend(ids[new])
                frontier.extend(new)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _bucket_members(reps: DataFrame) -> DataFrame:
    """``(key, doc_id, pivot)``: the members of every table bucket that holds
    two documents or more, with its smallest id.

    A half that no other document has cannot be part of a shared key, so only
    halves seen twice are combined.
    """
    halves = reps.select("doc_id", F.posexplode("halves").alias("i", "h"))
    twice = halves.groupBy("i", "h").agg(F.count("*").alias("c")).where("c > 1")
    lists = materialize(
        halves.join(twice.drop("c"), ["i", "h"], "left_semi")
        .groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("i", "h"))).alias("l"))
        .where("size(l) > 1"), "minhash-halves")
    keys = lists.select("doc_id", F.explode(F.expr(
        "flatten(transform(l, (a, x) -> transform(slice(l, x + 2, size(l)), "
        "b -> xxhash64(a.i, a.h, b.i, b.h))))")).alias("key"))
    pivots = (
        keys.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("top"))
        .where("pivot < top").drop("top")
    )
    return materialize(keys.join(pivots, "key"), "minhash-buckets")


def _size_fits(a: Column, b: Column, percent: int) -> Column:
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of every document to one pivot."""
    pairs = members.where("doc_id > pivot").groupBy("doc_id").agg(F.min("pivot").alias("pivot"))
    joined = (
        pairs.select(F.col("doc_id").alias("u"), F.col("pivot").alias("v"))
        .join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")), "u")
        .join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b")), "v")
        .where(_size_fits(F.size("a"), F.size("b"), percent))
        .select("u", "v", "a", "b")
    )
    return materialize(joined.mapInArrow(_confirm(percent), "u long, v long"), "minhash-links")


def _open_documents(members: DataFrame, sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """``(doc_id, comp)`` of the documents that may still have a link to
    another component: their bucket spans components, and neither their size
    nor their count of shared shingles excludes every member."""
    labelled = (
        members.select("key", "doc_id")
        .join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("key", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
    )

    def spanning(rows: DataFrame) -> DataFrame:
        wide = (
            rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi").select("key")
        )
        return rows.join(wide, "key", "left_semi")

    rows = materialize(spanning(labelled), "minhash-spanning")
    ids = rows.select("doc_id").distinct()
    own = sets.join(ids, "doc_id", "left_semi")
    alone = (
        own.select("doc_id", F.explode("shingles").alias("s"))
        .groupBy("s").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id"))
        .where("c = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    )
    # |a & b| <= shared and |a & b| >= t / (1 + t) * (|a| + |b|) bound |b| from above
    n, shared = F.col("n"), F.col("n") - F.coalesce("alone", F.lit(0))
    limits = (
        own.select("doc_id", F.size("shingles").alias("n")).join(alone, "doc_id", "left")
        .select("doc_id", "n", F.floor(shared * (100 + percent) / percent - n + 1e-6).alias("most"))
        .where(100 * F.col("most") >= percent * F.col("n"))
    )
    rows = rows.join(limits, "doc_id")
    least = rows.groupBy("key").agg(F.min("n").alias("least"))
    rows = rows.join(least, "key").where("most >= least").select("key", "doc_id", "comp")
    return spanning(rows).select("doc_id", "comp").distinct()


def _open_links(open_docs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between open documents of different components, found in cells of
    bounded size; the block of a document is a hash of its id."""
    open_docs = materialize(open_docs, "minhash-open")
    sized = open_docs.join(sets, "doc_id").select("doc_id", "comp", F.size("shingles").alias("n"))
    meet = (
        reps.select("doc_id", "coarse").join(sized, "doc_id")
        .select("doc_id", "comp", "n", F.posexplode("coarse").alias("i", "m"))
    )
    groups = (
        meet.groupBy("i", "m")
        .agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo < hi")
        .select("i", "m", F.ceil(F.greatest(F.col("c") / CELL_ROWS, F.col("n") / CELL_SHINGLES)).cast("int").alias("parts"))
    )
    cells = (
        meet.drop("n").join(groups, ["i", "m"])
        .withColumn("side", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("i", "m", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"),
                "side", "doc_id", "comp")
    )
    return (
        cells.join(sets, "doc_id").groupBy("i", "m", "lo", "hi")
        .applyInArrow(_cell_links(percent), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_per_shingle: int = 5, percent: int = 80,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Two documents are linked when their sets of distinct word shingles have
    ``100 * intersection >= percent * union``; a component is named by its
    smallest id, and that document is the one ``kept``. Words are runs of
    bytes other than ASCII white space, A-Z lower-cased; a text of fewer words
    than a shingle is one shingle. Null and empty texts have an empty set and
    no links. Rows with a null id keep their count, have a null component and
    are kept. Repeated rows share a class; rows of one id with other texts are
    one document in the links (:func:`remove_duplicates` tells them apart).
    Other columns are ignored; an empty table gives an empty result. A
    ``percent`` below ``LEAST_PERCENT`` would need more halves and raises
    ``ValueError``.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    sig = materialize(docs.mapInArrow(
        _signatures(words_per_shingle),
        "doc_id long, n_shingles long, h1 long, h2 long, halves array<long>, coarse array<long>"), "minhash-signatures")
    of_class = ["h1", "h2", "n_shingles"]
    held = sig.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(held.groupBy(*of_class).agg(F.min("doc_id").alias("rep")), "minhash-classes")
    reps = materialize(
        held.join(classes, of_class).where("doc_id = rep").select("doc_id", "halves", "coarse"), "minhash-reps")

    members = _bucket_members(reps)
    bitmap = spark.sparkContext.broadcast(_bitmap(members.select("doc_id")))
    sets = materialize(
        docs.where("doc_id is not null").mapInArrow(_sets(words_per_shingle, bitmap), "doc_id long, shingles array<long>")
        .join(members.select("doc_id").distinct(), "doc_id", "left_semi"), "minhash-sets")
    star = _star_links(members, sets, percent)
    open_docs = _open_documents(members, sets, connected_components(star), percent)
    links = star.unionByName(_open_links(open_docs, reps, sets, percent))
    found = connected_components(links)

    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        *of_class, F.coalesce("component", "rep").alias("component_id"))
    return (
        sig.drop("halves", "coarse").join(named, of_class, "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
            .otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def remove_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5, percent: int = 80,
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one row of each group
    of near duplicates does: that with the smallest id, null ids last.

    Rows are told apart by a number of their own, so an id may have any number
    of rows and texts: each is in the group that its text is in. Rows without a
    word stay. The numbered rows are written once.
    """
    row = "row_" + "_".join(docs.columns)  # no column's name
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    found = near_duplicates(rows, row, text_col, words_per_shingle, percent).select(F.col("doc_id").alias(row), "component_id")
    of_id = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row).alias("at"))
    grouped = materialize(rows.select(row, id_col).join(found, row).withColumn("of", of_id), "grouped-rows")
    # joined by the row, so that no large component meets in one task
    kept = grouped.groupBy("component_id").agg(F.min("of").alias("kept")).select(F.col("kept.at").alias(row))
    dropped = materialize(grouped.select(row).join(kept, row, "left_anti"), "dropped-rows")
    return rows.join(dropped, row, "left_anti").select(docs.columns)
