"""Packing by optimal length buckets.

The lengths of all documents within the token budget form one global, exact
histogram. Dynamic programming over it chooses the bucket boundaries that pad
least: a document is padded to its bucket's boundary, a batch of a bucket holds
as many documents as the token budget allows at that length. Documents are
never cut; one longer than the budget is a batch of its own at its own length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import freeing
from scriptorium.session import materialize

# rows that are numbered in one task, about
NUMBERED_ROWS = 100_000


def choose_boundaries(lengths: list[int], counts: list[int], buckets: int) -> tuple[list[int], int]:
    """The at most ``buckets`` boundaries with the least padding, and that
    padding. ``lengths`` ascend; boundaries are some of them, the last always.
    Of equally good choices, each boundary from the top is the smallest.

    ``cost[j]`` for one more bucket is the least of ``cost[i] + L[j] * (C[j] -
    C[i]) - (S[j] - S[i])`` over ``i < j`` with the running count ``C`` and sum
    ``S``: lines in ``L[j]`` with falling slopes, so a layer takes linear time.
    """
    m = len(lengths)
    if not m:
        return [], 0
    c, s = [0], [0]
    for length, n in zip(lengths, counts):
        c.append(c[-1] + n)
        s.append(s[-1] + length * n)
    cost = [0] + [lengths[j] * c[j + 1] - s[j + 1] for j in range(m)]
    froms = []
    for _ in range(1, min(buckets, m)):
        new, back = [0] * (m + 1), [0] * (m + 1)
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        at = 0
        for j in range(1, m + 1):
            i = j - 1
            line = (-c[i], cost[i] + s[i], i)
            while len(hull) - at >= 2:
                (k1, b1, _), (k2, b2, _) = hull[-2], hull[-1]
                if (b2 - b1) * (k2 - line[0]) >= (line[1] - b2) * (k1 - k2):
                    hull.pop()
                else:
                    break
            hull.append(line)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            k, b, i = hull[at]
            new[j], back[j] = k * x + b + x * c[j] - s[j], i
        froms.append(back)
        cost = new
    out, j = [], m
    for back in reversed(froms):
        out.append(lengths[j - 1])
        j = back[j]
        if not j:
            break
    if j:
        out.append(lengths[j - 1])
    return out[::-1], cost[m]


def length_histogram(rows: DataFrame) -> tuple[list[int], list[int]]:
    """All lengths (at least 1) and their counts; for rows within a budget, so
    that there are no more of them than tokens in it."""
    length = F.greatest(F.col("n_tokens"), F.lit(1)).cast("long")
    found = rows.groupBy(length.alias("length")).agg(F.count("*").alias("n")).orderBy("length").collect()
    return [r["length"] for r in found], [r["n"] for r in found]


def _bucket_of(boundaries: list[int]) -> Column:
    """Number of the smallest boundary that holds the document."""
    lower = F.array(*[F.lit(b) for b in boundaries])
    return F.size(F.filter(lower, lambda b: b < F.col("n_tokens")))


def pack(rows: DataFrame, budget: int, buckets: int = 16, id_col: str = "doc_id", length_col: str = "n_tokens") -> DataFrame:
    """``doc_id, n_tokens, bucket, padded_to, batch, slot``, one row per input
    row: the bucket (from 0), the length it is padded to, the number of its
    batch (from 0, over all buckets) and its place in the batch.

    A batch of bucket b holds ``budget // boundary_b`` documents; only the last
    batch of a bucket may hold fewer. Documents over the budget take no part in
    the choice of boundaries: they are one more bucket behind the others, each
    a batch of its own without padding. Null and negative lengths count
    as 0, and empty documents are padded like others; rows with a null id and
    repeated rows are packed like others. Other columns are ignored; an empty
    table gives no rows.
    """
    spark = rows.sparkSession
    slim = materialize(rows.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0)).alias("n_tokens"),
        F.monotonically_increasing_id().alias("row")), "lengths")
    lengths, counts = length_histogram(slim.where(F.col("n_tokens") <= budget))
    boundaries, _ = choose_boundaries(lengths, counts, buckets)
    if not boundaries:
        boundaries = [1]
    # the last bucket is that of documents over the budget
    over = len(boundaries)
    bucket = F.when(F.col("n_tokens") > budget, F.lit(over)).otherwise(_bucket_of(boundaries))
    held = F.when(F.col("bucket") == over, F.col("n_tokens")).otherwise(
        F.array(*[F.lit(b).cast("long") for b in boundaries])[F.col("bucket")])
    per_batch = F.array(*[F.lit(max(1, budget // b)) for b in boundaries], F.lit(1))
    # rows are numbered in two levels, so that no task holds a whole bucket
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-slim.count() // NUMBERED_ROWS))
    placed = slim.withColumn("bucket", bucket).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    batches = sizes.groupBy("bucket").agg(F.sum("n").alias("n")).select(
        "bucket", F.ceil(F.col("n") / per_batch[F.col("bucket")]).alias("batches"))
    first = {r["bucket"]: r["batches"] for r in batches.collect()}
    starts = np.cumsum([0] + [first.get(b, 0) for b in range(over)]).tolist()
    number = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("row")) - 1 + F.col("offset")
    return (
        placed.join(offsets, ["bucket", "part"]).withColumn("number", number)
        .withColumn("in_batch", per_batch[F.col("bucket")])
        .select(
            "doc_id", "n_tokens", "bucket", held.alias("padded_to"),
            (F.array(*[F.lit(s) for s in starts])[F.col("bucket")] + F.floor(F.col("number") / F.col("in_batch"))).alias("batch"),
            (F.col("number") % F.col("in_batch")).alias("slot"))
    )


def batches(packed: DataFrame) -> DataFrame:
    """``batch, bucket, padded_to, n_docs, n_tokens, n_padding, doc_ids``, one
    row per batch; ``doc_ids`` in slot order. A batch holds at most the token
    budget of documents."""
    return (
        packed.groupBy("batch", "bucket", "padded_to")
        .agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
             F.sort_array(F.collect_list(F.struct("slot", "doc_id"))).alias("docs"))
        .select("batch", "bucket", "padded_to", "n_docs", "n_tokens",
                (F.col("padded_to") * F.col("n_docs") - F.col("n_tokens")).alias("n_padding"),
                F.col("docs.doc_id").alias("doc_ids"))
    )


def token_lengths(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` of whole texts, the end id included. ``tokenizer``
    is the file's path in the shared folder."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scriptorium.llm.id_store import _encoder, _ids_of

        for batch in freeing(batches_):
            for lo, _, counts in _ids_of(batch, _encoder(tokenizer), end_id, np.uint32):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(counts)), pa.array(counts)], names=["doc_id", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")
