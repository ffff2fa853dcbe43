"""Exact top-k inner products by columnar branch and bound.

Vectors are stored in blocks with a vertical layout: dimension by dimension,
a few dimensions (a plane) at a time, with the mass (squared length) that each
vector has left behind every plane. A block of queries meets a block of
candidates plane by plane: scores accumulate, and after each plane the
candidates whose score plus ``|rest of query| * |rest of candidate|`` cannot
reach the query's k-th best score are dropped and the survivors compacted.

The k-th best scores to beat come from a first search over one block in
``SEED_STEP``; they are stored with the query blocks. The query set meets all
rows in blocks: tasks hold candidate blocks and read one query block at a time
from the shared folder, so memory does not depend on either table's size, and
a task returns at most k rows a query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import Writer, freeing, qualified, read_bytes
from scriptorium.session import materialize, scratch_path

BLOCK_ROWS, QUERY_ROWS, PLANE = 4096, 512, 8
SEED_STEP = 16
# survivors are compacted to pairs once fewer than this share is left
SPARSE = 0.1
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass
class Block:
    """Vectors by dimension (``columns[d, i]``), with the length of what is
    left of each behind every plane; ``floor`` is the score to beat."""

    ids: np.ndarray
    null: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    rest: np.ndarray
    floor: np.ndarray


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def make_block(scale: int, ids: pa.Array, rows: pa.Array, vectors: pa.Array, floor: pa.Array | None = None) -> Block:
    values, n = _lists(vectors)
    values = np.floor(scale * values)
    width = -(-max(1, int(n.max(initial=0))) // PLANE) * PLANE
    columns = np.zeros((width, len(n)))
    owner = np.repeat(np.arange(len(n)), n)
    columns[np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n), owner] = values
    mass = np.add.reduceat(columns * columns, np.arange(0, width, PLANE), axis=0)
    rest = np.sqrt(np.cumsum(mass[::-1], axis=0)[::-1])
    beat = np.full(len(n), -np.inf) if floor is None else floor.fill_null(LEAST).to_numpy().astype(np.float64)
    return Block(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), rows.to_numpy(), columns,
                 np.vstack([rest, np.zeros(len(n))]), np.where(beat <= LEAST, -np.inf, beat))


def _exact_scores(q: Block, c: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores beyond the exact range of doubles, as Python integers; one
    outside of a long becomes the nearest long."""
    out = np.empty(len(i), np.int64)
    for at, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        total = sum(int(x) * int(y) for x, y in zip(q.columns[:, a], c.columns[:, b]))
        out[at] = min(max(total, LEAST), MOST)
    return out


def scan(q: Block, c: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate, score) that may be among the ``k`` best of a
    query: at most ``k`` of each, ties to the smaller id."""
    planes = min(q.columns.shape[0], c.columns.shape[0]) // PLANE
    most = float(q.rest[0].max(initial=0)) * float(c.rest[0].max(initial=0))
    exact = most < 2.0 ** 53
    kind = np.float32 if most < 2.0 ** 24 else np.float64
    # what rounding may take from a bound
    slack = 1e-5 * most + 1e-3
    floor = (q.floor - slack)[:, None]
    score = np.zeros((len(q.ids), len(c.ids)), kind)
    i = j = pairs = None
    for p in range(planes):
        a, b = p * PLANE, (p + 1) * PLANE
        if pairs is None:
            score += q.columns[a:b].T.astype(kind) @ c.columns[a:b].astype(kind)
            bound = score + q.rest[p + 1][:, None].astype(kind) * c.rest[p + 1].astype(kind)
            alive = bound >= floor
            left = np.count_nonzero(alive)
            if left < SPARSE * alive.size:
                i, j = np.nonzero(alive)
                pairs = score[i, j].astype(np.float64)
        else:
            pairs += np.einsum("dn,dn->n", q.columns[a:b, i], c.columns[a:b, j])
            keep = pairs + q.rest[p + 1][i] * c.rest[p + 1][j] >= floor[i, 0]
            i, j, pairs = i[keep], j[keep], pairs[keep]
    if pairs is None:
        i, j = np.nonzero(score >= floor)
        pairs = score[i, j].astype(np.float64)
    keep = (q.rows[i] != c.rows[j]) & (pairs >= floor[i, 0])
    i, j, pairs = i[keep], j[keep], pairs[keep]
    scores = np.rint(pairs).astype(np.int64) if exact else _exact_scores(q, c, i, j)
    order = np.lexsort((c.rows[j], c.ids[j], c.null[j], ~scores, i))
    i, j, scores = i[order], j[order], scores[order]
    first = np.searchsorted(i, np.arange(len(q.ids)))
    keep = np.arange(len(i)) - first[i] < k
    return i[keep], j[keep], scores[keep]


def _store_queries(folder: str, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in freeing(batches):
            for lo in range(0, batch.num_rows, QUERY_ROWS):
                piece = batch.slice(lo, QUERY_ROWS)
                block = make_block(scale, *(piece.column(c) for c in ("vec_id", "row", "vector", "floor")))
                out = Writer(f"{folder}/{part:06d}-{number:06d}")
                out.write(pickle.dumps(block, pickle.HIGHEST_PROTOCOL))
                yield pa.RecordBatch.from_pydict({"file": [out.close()]})
                number += 1

    return run


def _blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[Block]:
    """Candidate blocks of up to ``BLOCK_ROWS`` rows."""
    held, n = [], 0
    for batch in freeing(batches):
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            piece = batch.slice(lo, BLOCK_ROWS)
            if n and n + piece.num_rows > BLOCK_ROWS:
                yield _joined(held, scale)
                held, n = [], 0
            held.append(piece)
            n += piece.num_rows
    if n:
        yield _joined(held, scale)


def _joined(pieces: list[pa.RecordBatch], scale: int) -> Block:
    table = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
    return make_block(scale, *(table.column(c) for c in ("vec_id", "row", "vector")))


FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _search(files: list[str], k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches, scale):
            for uri in files:
                q = pickle.loads(read_bytes(uri))
                i, j, score = scan(q, c, k)
                if len(i):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(q.rows[i]), pa.array(q.ids[i], mask=q.null[i]), pa.array(c.ids[j], mask=c.null[j]),
                        pa.array(c.rows[j]), pa.array(score)],
                        names=["query_row", "query_id", "vec_id", "row", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _query_files(queries: DataFrame, scale: int) -> list[str]:
    """Write the query blocks; the driver gets one file name a block."""
    spark = queries.sparkSession
    folder = qualified(spark, scratch_path(spark, "queries"))
    return [r[0] for r in queries.mapInArrow(_store_queries(folder, scale), "file string").orderBy("file").collect()]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query``, the
    ``k`` other rows with the highest inner product of the vectors' integer
    parts ``floor(scale * x)``; all others if there are fewer. Ties go to the
    smaller id, null ids last.

    Null vectors and those with a null or non-finite component take no part;
    of vectors of different lengths the shorter ends in zeros. Repeated ids are
    rows of their own: a query leaves out its own row only. Scores are exact;
    one beyond a long becomes the nearest long. Other columns are ignored; an
    empty table gives no rows.
    """
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("is_query"))
        .where(F.col("vector").isNotNull() & finite)
        .withColumn("row", F.monotonically_increasing_id())
    )
    rows = materialize(rows, "vectors")
    # the blocks of the first search are chosen by a hash of the row
    seed = F.pmod(F.xxhash64("row"), F.lit(SEED_STEP)) == 0
    queries = rows.where("is_query").select("vec_id", "row", "vector")
    no_floor = queries.withColumn("floor", F.lit(None).cast("long"))
    candidates = rows.select("vec_id", "row", "vector")
    files = _query_files(no_floor, scale)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = candidates.where(seed).repartition(-(-parts // SEED_STEP), "row")
    first = materialize(_best(some.mapInArrow(_search(files, k, scale), FOUND), k).drop("rank"), "seeds")
    floors = first.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("floor")) \
        .where(F.col("n") == k).select(F.col("query_row").alias("row"), "floor")
    files = _query_files(queries.join(floors, "row", "left").select("vec_id", "row", "vector", "floor"), scale)
    rest = candidates.where(~seed).repartition(parts, "row").mapInArrow(_search(files, k, scale), FOUND)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
