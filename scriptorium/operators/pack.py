"""Packing of an ordered token stream into fixed-length sequences.

The stream is the concatenation of every document's ids in order of the
order key, with no separator between documents; it is cut into windows of
``max_seq_len`` and the incomplete tail is discarded. Labels equal the ids.

The stream is never materialised. Each document gets its global ``start``
(an exclusive running sum of lengths, see :mod:`ordering`), emits one piece
per window it overlaps (``slice`` of its own ids), and pieces are regrouped
by window id. A window holds at most ``max_seq_len`` ids, so every group is
bounded by construction, whatever the document sizes or key skew. The
result does not depend on the number or layout of input partitions.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators import pack_ranges
from scriptorium.operators.ordering import exclusive_running_sum
from scriptorium.session import materialize, small_batches


def token_offsets(tokens: DataFrame, order_col: str = "ord", ids_col: str = "input_ids",
                  n_buckets: int | None = None, len_col: str | None = None) -> tuple[DataFrame, int, int]:
    """``(order_col, n, start)`` per document, the total token count and the
    document count. ``len_col`` names a stored length column, so the ids
    themselves are not read."""
    n = F.col(len_col) if len_col else F.size(ids_col)
    lens = tokens.select(order_col, n.cast("bigint").alias("n"))
    return exclusive_running_sum(lens, [order_col], "n", "start", n_buckets)


def _pieces(df: DataFrame, ids_col: str, L: int, n_seqs: int) -> DataFrame:
    start, n = F.col("start"), F.col("n")
    first = F.expr(f"start div {L}")
    last = F.least(F.expr(f"(start + n - 1) div {L}"), F.lit(n_seqs - 1))

    def piece(s: Column) -> Column:
        lo = F.greatest(start, s * L)
        hi = F.least(start + n, (s + 1) * L)
        return F.struct(
            s.alias("seq_id"),
            lo.alias("pos"),
            F.slice(F.col(ids_col), (lo - start + 1).cast("int"), (hi - lo).cast("int")).alias("piece"),
        )

    return (
        df.where((n > 0) & (first < n_seqs))
        .select(F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
        .select("p.*")
    )


def pack_sequences(tokens: DataFrame, max_seq_len: int = 2048, order_col: str = "ord",
                   ids_col: str = "input_ids", n_buckets: int | None = None, materialize_input: bool = True) -> DataFrame:
    """``seq_id, input_ids, labels``; every row exactly ``max_seq_len`` long,
    as :func:`pack_counted` builds them."""
    return pack_counted(tokens, max_seq_len, order_col, ids_col, n_buckets, materialize_input)[0]


def pack_counted(tokens: DataFrame, max_seq_len: int = 2048, order_col: str = "ord",
                 ids_col: str = "input_ids", n_buckets: int | None = None, materialize_input: bool = True,
                 ranges: Callable[[int], int] | None = None) -> tuple[DataFrame, int]:
    """``seq_id, input_ids, labels``, every row exactly ``max_seq_len`` long, and
    the number of rows, which is known before any is built.

    The input is written once (``order, n, ids``) to the checkpoint folder:
    lengths and slices both read it, a Python tokenizer upstream runs once,
    and the lineage is cut before the two shuffles. Lengths are then read
    from their own column without touching the ids. A repeated or null
    ``order_col`` raises ``ValueError``.

    ``ranges`` lays the rows out for files: given the number of ids packed it
    says how many partitions, each a contiguous range of ``seq_id`` in order
    (see :mod:`pack_ranges`: ids are kept compressed and shuffled once).
    """
    L = int(max_seq_len)
    if L <= 0:
        raise ValueError("max_seq_len must be positive")
    compact = ranges is not None and pack_ranges.applies(tokens, order_col, ids_col)
    if compact:
        src = pack_ranges.stored(tokens, order_col, ids_col)
    else:
        src = tokens.select(order_col, ids_col, F.size(ids_col).cast("bigint").alias("_n"))
    if materialize_input:
        with small_batches(tokens.sparkSession) if compact else contextlib.nullcontext():
            src = materialize(src, "tokens")
    # slim keys only; a repeated or null key would not join its own ids
    bad = src.groupBy(order_col).count().where((F.col("count") > 1) | F.col(order_col).isNull()).head(1)
    if bad:
        raise ValueError(f"{order_col} must be unique and not null; found {bad[0][order_col]!r} {bad[0]['count']} times")
    offsets, total, _ = token_offsets(src, order_col, ids_col, n_buckets, len_col="_n")
    n_seqs = total // L
    spark = tokens.sparkSession
    if n_seqs == 0:
        return spark.createDataFrame([], "seq_id bigint, input_ids array<int>, labels array<int>"), 0
    offsets = offsets.select(order_col, "n", "start")
    if compact:
        packed = pack_ranges.packed_ranges(src, offsets, order_col, L, n_seqs, ranges(n_seqs * L))
        return packed.withColumn("labels", F.col("input_ids")), n_seqs
    joined = src.select(order_col, ids_col).join(offsets, order_col)
    grouped = (
        _pieces(joined, ids_col, L, n_seqs)
        .groupBy("seq_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("ps"))
    )
    ids = F.flatten(F.transform("ps", lambda p: p["piece"]))
    # labels reference the computed ids (Catalyst keeps the flatten single).
    packed = grouped.select("seq_id", ids.alias("input_ids")).withColumn("labels", F.col("input_ids"))
    if ranges is not None:
        packed = packed.repartitionByRange(ranges(n_seqs * L), "seq_id").sortWithinPartitions("seq_id")
    return packed, n_seqs


def pack_stats(tokens: DataFrame, max_seq_len: int = 2048, ids_col: str = "input_ids") -> DataFrame:
    """Total tokens, kept sequences, discarded tail and its percentage (one row)."""
    L = int(max_seq_len)
    total = F.coalesce(F.sum(F.size(ids_col)), F.lit(0)).cast("bigint")
    agg = tokens.agg(total.alias("total_tokens"))
    seqs = F.expr(f"total_tokens div {L}")
    discarded = F.col("total_tokens") - seqs * L
    return agg.select(
        "total_tokens",
        seqs.alias("sequences"),
        (seqs * L).alias("kept_tokens"),
        discarded.cast("bigint").alias("discarded_tokens"),
        F.round(discarded / F.greatest(F.lit(1), F.col("total_tokens")) * 100, 6).alias("discarded_pct"),
    )


def packed_stats(packed: DataFrame, decode, ids_col: str = "input_ids", sample_len: int = 8) -> DataFrame:
    """Row count, token count (rows x length of the first row) and a decode
    of the first ``sample_len`` ids of sequence 0 (one row, one aggregation)."""
    first = F.min(F.struct("seq_id", F.size(ids_col).alias("len"), F.slice(ids_col, 1, sample_len).alias("head")))
    counts = packed.agg(F.count(F.lit(1)).cast("bigint").alias("sequences"), first.alias("first"))
    return counts.select(
        "sequences",
        (F.col("sequences") * F.coalesce(F.col("first.len"), F.lit(0))).cast("bigint").alias("tokens"),
        decode(F.col("first.head")).alias("sample_text"),
    )


def clm_labels(packed: DataFrame, pad_id: int, ids_col: str = "input_ids", out_col: str = "labels") -> DataFrame:
    """Causal-LM collation labels: ids, with every pad-id position set to -100.

    With pad = eos (no pad token), any eos in the text is masked too.
    """
    return packed.withColumn(out_col, F.transform(ids_col, lambda x: F.when(x == pad_id, F.lit(-100)).otherwise(x)))


def preview_chunk(packed: DataFrame, decode, seed: int = 42) -> DataFrame:
    """One reproducible pseudo-random sequence, decoded.

    The pick is the smallest ``md5(seed:seq_id)``; an empty input gives no row
    (the console wrap of the text is presentation and left to the caller).
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("seq_id").cast("string")))
    picked = packed.select("seq_id", "input_ids", key.alias("_k")).orderBy("_k", "seq_id").limit(1)
    return picked.select("seq_id", decode(F.col("input_ids")).alias("text"))


def preview_window(tokens: DataFrame, decode, max_seq_len: int = 2048, seed: int = 42, order_col: str = "ord",
                   ids_col: str = "input_ids") -> DataFrame:
    """:func:`preview_chunk` of the packed ``tokens`` without packing them.

    The number of windows follows from the lengths, so the window is picked
    first; only the documents whose interval overlaps it give a slice. Each of
    them holds one of its ids or more, so they are at most ``max_seq_len``.
    """
    L = int(max_seq_len)
    src = materialize(tokens.select(order_col, ids_col, F.size(ids_col).cast("bigint").alias("_n")), "tokens")
    offsets, total, _ = token_offsets(src, order_col, ids_col, len_col="_n")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    picked = tokens.sparkSession.range(total // L).orderBy(key, "id").head(1)
    seq = picked[0]["id"] if picked else -1
    lo, hi = seq * L, (seq + 1) * L
    start, end = F.col("start"), F.col("start") + F.col("n")
    inside = offsets.where((F.col("n") > 0) & (start < hi) & (end > lo)).select(order_col, "n", "start")
    begin = F.greatest(start, F.lit(lo))
    piece = F.struct("start", F.slice(F.col(ids_col), (begin - start + 1).cast("int"),
                                      (F.least(end, F.lit(hi)) - begin).cast("int")).alias("piece"))
    window = src.join(F.broadcast(inside), order_col).agg(F.array_sort(F.collect_list(piece)).alias("ps"))
    ids = F.flatten(F.transform("ps", lambda p: p["piece"]))
    return window.where(F.size("ps") > 0).select(F.lit(seq).cast("bigint").alias("seq_id"), decode(ids).alias("text"))


def training_plan(packed: DataFrame, batch_size: int = 2, grad_accum: int = 4, num_epochs: int = 3,
                  steps_per_second: float = 0.25) -> DataFrame:
    """:func:`plan_of_count` of a packed dataset."""
    n = packed.agg(F.count(F.lit(1)).cast("bigint").alias("sequences"))
    return plan_of_count(n, batch_size, grad_accum, num_epochs, steps_per_second)


def plan_of_count(n: DataFrame, batch_size: int = 2, grad_accum: int = 4, num_epochs: int = 3,
                  steps_per_second: float = 0.25) -> DataFrame:
    """Steps per epoch, total steps and duration estimate (one row) for a
    one-row table of ``sequences``, such as :func:`pack_stats` gives without
    packing."""
    if batch_size <= 0 or grad_accum <= 0 or num_epochs <= 0 or steps_per_second <= 0:
        raise ValueError("batch_size, grad_accum, num_epochs and steps_per_second must be positive")
    eff = batch_size * grad_accum
    spe = F.greatest(F.lit(1), F.ceil(F.col("sequences") / F.lit(eff))).cast("bigint")
    total = spe * num_epochs
    secs = total / F.lit(float(steps_per_second))
    whole = F.floor(secs).cast("bigint")
    h = F.floor(whole / 3600).cast("bigint")  # exact: whole < 2**53
    m = F.floor((whole % 3600) / 60).cast("bigint")
    return n.select(
        "sequences",
        F.lit(eff).cast("bigint").alias("effective_batch"),
        spe.alias("steps_per_epoch"),
        total.alias("total_steps"),
        F.round(secs, 6).alias("total_seconds"),
        h.alias("hours"), m.alias("minutes"), (whole % 60).cast("bigint").alias("seconds"),
        F.floor(h / num_epochs).cast("bigint").alias("epoch_hours"),
        F.floor(m / num_epochs).cast("bigint").alias("epoch_minutes"),
    )


def steps_per_second_for(use_ddp: bool) -> float:
    """The step-rate default: 0.50 when training under DDP, else 0.25 (the
    GPU count does not enter the estimate)."""
    return 0.5 if use_ddp else 0.25

