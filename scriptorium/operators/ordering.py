"""Global order statistics without a single-partition window.

A running total over a global order (token offsets, row numbers) is built in
two levels: rows are range-partitioned by the order key (balanced by the
sampled key distribution, whatever its skew), the partition id is fixed by
writing the slim result to the checkpoint folder, per-partition totals form
a table with one row per partition (its size is the partition count, a
proven bound, so it is broadcast), and a window inside each partition adds
the local part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.session import materialize


def default_buckets(spark) -> int:
    """Range partitions for the two-level statistics: the session's shuffle
    partition count, the knob already sized so a partition fits a task. No
    counting pass is needed; the range bounds balance rows across them."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def exclusive_running_sum(df: DataFrame, order_cols: list[str], value_col: str, out_col: str,
                          n_buckets: int | None = None) -> tuple[DataFrame, int, int]:
    """``df`` (slim: order columns + value) with ``out_col`` = sum of ``value_col``
    over all rows strictly before it in ``order_cols`` order. Also returns the
    grand total and the row count (driver scalars).

    One plan at every size: range partitions fixed by a write, broadcast
    per-partition totals, a window inside each. Rows with equal keys each
    keep their place; which of them comes first is not defined. Null keys
    come first.
    """
    slim = df.select(*order_cols, value_col)
    if n_buckets is None:
        n_buckets = default_buckets(df.sparkSession)
    ranged = materialize(
        slim.repartitionByRange(n_buckets, *order_cols).withColumn("_bucket", F.spark_partition_id()),
        "ranged",
    )
    totals = ranged.groupBy("_bucket").agg(F.sum(value_col).alias("_btot"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by n_buckets, safe to broadcast.
    offsets = totals.select(
        "_bucket", F.coalesce(F.sum("_btot").over(before), F.lit(0)).cast("bigint").alias("_boff"),
        F.col("_btot"), F.col("_rows"),
    )
    off_rows = offsets.collect()
    grand_total = int(sum(r["_btot"] or 0 for r in off_rows))
    n_rows = int(sum(r["_rows"] for r in off_rows))
    offsets_df = df.sparkSession.createDataFrame(
        [(r["_bucket"], r["_boff"]) for r in off_rows], "_bucket int, _boff bigint"
    )
    local = Window.partitionBy("_bucket").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    out = (
        ranged.withColumn("_local", F.coalesce(F.sum(value_col).over(local), F.lit(0)))
        .join(F.broadcast(offsets_df), "_bucket")
        .select(*order_cols, value_col, (F.col("_boff") + F.col("_local")).cast("bigint").alias(out_col))
    )
    return out, grand_total, n_rows


def global_row_index(df: DataFrame, order_cols: list[str], out_col: str = "row_index",
                     n_buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order. Every row gets a
    number of its own: rows with equal keys in no defined order, null keys first.

    Range partitioning plus ``sortWithinPartitions`` gives each partition a
    consecutive key range in order, so ``monotonically_increasing_id`` is a
    local position; the write fixes it; a one-row-per-partition count table
    (broadcast) turns it into a global one. One shuffle, no window.
    """
    if n_buckets is None:
        n_buckets = default_buckets(df.sparkSession)
    ranged = materialize(
        df.repartitionByRange(n_buckets, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "indexed",
    )
    part = F.shiftright("_mid", 33)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # One row per partition: bounded by n_buckets.
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out_col, (F.col("_off") + local).cast("bigint"))
        .drop("_mid", "_part", "_off")
    )
