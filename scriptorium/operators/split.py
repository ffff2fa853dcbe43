"""Reproducible train / eval split with an exact eval size.

Rows are ordered by ``md5("<seed>:<key>")`` (ties by key) and the first
``ceil(fraction * n)`` rows are eval. The split is independent of
partitioning and equal to what SQL computes with ``row_number``.

No global sort runs: md5 digests are uniform, so counting rows per digest
prefix (4,096 buckets per level, a bounded table) locates the bucket that
holds the k-th row; the prefix is lengthened until that bucket is small,
and a window inside it alone yields the exact threshold. Every row is then
labelled by one comparison, a narrow projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.session import materialize

SMALL_BUCKET = 200_000


def split_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def eval_size(n: int, fraction: float | int) -> int:
    """``ceil(fraction * n)`` for a float fraction, the count itself for an int."""
    if isinstance(fraction, int) and not isinstance(fraction, bool) and fraction >= 1:
        if fraction > n:
            raise ValueError(f"eval size {fraction} exceeds {n} rows")
        return fraction
    if not 0.0 <= float(fraction) < 1.0:
        raise ValueError("fraction must be in [0, 1)")
    return math.ceil(float(fraction) * n)


def _threshold(df: DataFrame, h: str, key: str, k: int):
    """(digest, key) of the k-th row (1-based) in (digest, key) order."""
    width, lo, cur = 3, 0, df
    while True:
        pre = F.substring(h, 1, width)
        counts = sorted(cur.groupBy(pre.alias("p")).count().collect())
        acc = lo
        for row in counts:
            if acc + row["count"] >= k:
                bucket, before, size = row["p"], acc, row["count"]
                break
            acc += row["count"]
        cur = cur.where(F.substring(h, 1, width) == bucket)
        lo = before
        if size <= SMALL_BUCKET or width >= 32:
            break
        width += 3
    w = Window.orderBy(h, key)
    row = cur.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == k - lo).select(h, key).first()
    return row[0], row[1]


def eval_threshold(df: DataFrame, key_col: str, fraction: float | int = 0.05, seed: int = 42):
    """``(digest, key)`` of the last eval row, or ``None`` when eval is empty."""
    h = split_hash(F.col(key_col), seed)
    # Slim (digest, key) pairs, written once: the search reads them a few times.
    keyed = materialize(df.select(h.alias("_h"), F.col(key_col)), "split_keys")
    k = eval_size(keyed.count(), fraction)
    if k == 0:
        return None
    return _threshold(keyed, "_h", key_col, k)


def is_eval(key_col: str, seed: int, threshold) -> Column:
    """The split label as one comparison against the threshold."""
    if threshold is None:
        return F.lit(False)
    th, tk = threshold
    h = split_hash(F.col(key_col), seed)
    return (h < F.lit(th)) | ((h == F.lit(th)) & (F.col(key_col) <= F.lit(tk)))


def train_eval_split(df: DataFrame, key_col: str, fraction: float | int = 0.05, seed: int = 42,
                     out_col: str = "split") -> DataFrame:
    """Adds ``split`` = ``"eval"`` / ``"train"``; ``key_col`` must be unique."""
    threshold = eval_threshold(df, key_col, fraction, seed)
    return df.withColumn(out_col, F.when(is_eval(key_col, seed, threshold), "eval").otherwise("train"))
