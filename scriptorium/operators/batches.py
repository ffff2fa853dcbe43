"""Batch formation and dynamic padding.

Batches are consecutive runs of ``batch_size`` rows in a deterministic order
(the last partial batch is kept); ``grad_accum`` batches form one optimizer
step. Padding extends every row to the longest row *of its batch*: ids get
the pad id, the attention mask 0 and the labels -100.

Rows are placed on slim ``(key, length)`` rows first, which also gives the
longest length of each batch; the payload is joined to its place once, and
padding is then a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators.ordering import global_row_index
from scriptorium.session import materialize

IGNORE = -100


def assign_batches(df: DataFrame, order_cols: list[str], batch_size: int = 2, grad_accum: int = 8,
                   n_buckets: int | None = None, by_length: str | None = None, ids_col: str = "input_ids") -> DataFrame:
    """``row_index``, ``batch_id``, ``step_id`` over the ``order_cols`` order,
    and ``batch_longest``, the greatest size of ``ids_col`` in the batch (null
    without that column).

    ``order_cols`` must be unique and not null; otherwise ``ValueError``. The
    payload is written once and moved at most once, in the join with its
    places. ``by_length`` names an array column: rows are then ordered by its size
    first (ties in ``order_cols`` order), so each batch holds rows of similar
    length and dynamic padding shrinks. Off by default (the plain order).
    """
    if batch_size <= 0 or grad_accum <= 0:
        raise ValueError("batch_size and grad_accum must be positive")
    src = materialize(df, "batch-rows")
    size = F.size(ids_col) if ids_col in df.columns else F.lit(None).cast("int")
    slim = src.select(*order_cols, size.alias("_size"), *([F.size(by_length).alias("_len")] if by_length else []))
    bad = slim.groupBy(*order_cols).count().where(
        (F.col("count") > 1) | F.concat_ws("", *[F.when(F.col(c).isNull(), "x") for c in order_cols]).contains("x")).head(1)
    if bad:
        raise ValueError(f"{order_cols} must be unique and not null; found {bad[0]}")
    order = ["_len", *order_cols] if by_length else list(order_cols)
    placed = global_row_index(slim, order, "row_index", n_buckets).withColumn(
        "batch_id", F.expr(f"row_index div {int(batch_size)}")).withColumn(
        "step_id", F.expr(f"row_index div {int(batch_size) * int(grad_accum)}"))
    placed = materialize(placed.withColumn("batch_longest", F.max("_size").over(Window.partitionBy("batch_id"))).select(
        *order_cols, "row_index", "batch_id", "step_id", "batch_longest"), "batch-places")
    return src.join(placed, list(order_cols)).select(*df.columns, "row_index", "batch_id", "step_id", "batch_longest")


def effective_batch(num_gpus: int, batch_size: int, grad_accum: int, use_ddp: bool = True) -> int:
    """Sequences of an optimizer step; without DDP one GPU counts."""
    return (max(1, num_gpus) if use_ddp else 1) * batch_size * grad_accum


def collate_pad(df: DataFrame, pad_id: int, batch_col: str = "batch_id", ids_col: str = "input_ids",
                mask_col: str = "attention_mask", labels_col: str = "labels") -> DataFrame:
    """Pad every row to the longest of its batch: ``batch_longest`` of
    :func:`assign_batches`, or a window over ``batch_col`` for other rows."""
    longest = F.col("batch_longest") if "batch_longest" in df.columns else F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    d = df.withColumn("_pad", longest - F.size(ids_col))
    return d.select(
        *[c for c in df.columns if c not in (ids_col, mask_col, labels_col, "batch_longest")],
        F.concat(ids_col, F.array_repeat(F.lit(pad_id), "_pad")).alias(ids_col),
        F.concat(mask_col, F.array_repeat(F.lit(0), "_pad")).alias(mask_col),
        F.concat(labels_col, F.array_repeat(F.lit(IGNORE), "_pad")).alias(labels_col),
    )
