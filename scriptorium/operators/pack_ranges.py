"""Packing laid out for files: every file one contiguous range of sequences.

The stream of ids is cut at the files' borders instead of the windows': of the
documents only those with a border inside are cut, the others go whole, as
compressed bytes, to the one file they belong to. A file's rows are sorted by
the order key and streamed into its sequences, so the ids are shuffled once,
by file, in about the size of their text, and no start is joined to them: the
driver holds the document of each border (a row per file).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.functions.tokens import SLICE

# order keys that Python orders as Spark does
KEYS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType(), T.StringType(), T.BinaryType())
IDS = T.ArrayType(T.IntegerType())
HEAD = 5  # bytes before the frame: the number of ids and of planes


def applies(tokens: DataFrame, order_col: str, ids_col: str) -> bool:
    """Whether ids and key are of types that this form takes."""
    of = tokens.schema
    return of[order_col].dataType in KEYS and of[ids_col].dataType.simpleString() == IDS.simpleString()


def ids_bytes(ids: pa.Array, codec: pa.Codec) -> bytes:
    """Ids as one zstd frame of byte planes (all lowest bytes, then the next
    ones), and a plane of validity if some are null."""
    planes = [ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i4", copy=False).view(np.uint8).reshape(-1, 4).T]
    if ids.null_count:
        planes.append(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)[None])
    raw = np.ascontiguousarray(np.concatenate(planes))
    return len(ids).to_bytes(4, "little") + bytes([len(raw)]) + codec.compress(raw, asbytes=True)


def bytes_ids(held: bytes, codec: pa.Codec) -> pa.Array:
    """Inverse of :func:`ids_bytes`."""
    n, planes = int.from_bytes(held[:4], "little"), held[4]
    raw = np.frombuffer(codec.decompress(memoryview(held)[HEAD:], n * planes), np.uint8).reshape(planes, n)
    ids = np.ascontiguousarray(raw[:4].T).view("<i4").reshape(n)
    return pa.array(ids, pa.int32(), mask=raw[4] == 0 if planes > 4 else None)


def stored(tokens: DataFrame, order_col: str, ids_col: str) -> DataFrame:
    """``order_col``, ``_n`` ids (null for null ids) and ``_ids``, their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            ids = batch.column(1)
            held = pa.array([ids_bytes(x.values, codec) if x.is_valid else None for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.list_value_length(ids).cast(pa.int64()), held], names=[order_col, "_n", "_ids"])

    schema = T.StructType([tokens.schema[order_col], T.StructField("_n", T.LongType()), T.StructField("_ids", T.BinaryType())])
    return tokens.select(order_col, ids_col).mapInArrow(run, schema)


def borders(offsets: DataFrame, order_col: str, L: int, n_seqs: int, files: int) -> list[tuple]:
    """Of each file the document that has its first id, and that document's
    start. File f has the sequences from ``f * n_seqs // files`` on."""
    start = F.col("start")
    # the windows that begin inside the document, and the files that begin with one of them
    first, last = F.expr(f"(start + {L - 1}) div {L}"), F.least(F.expr(f"(start + n - 1) div {L}"), F.lit(n_seqs - 1))
    rows = offsets.where(F.col("n") > 0).select(order_col, start, first.alias("_a"), last.alias("_b")).where("_a <= _b").select(
        order_col, "start", F.expr(f"(_a * {files} + {n_seqs - 1}) div {n_seqs}").alias("_f"),
        F.expr(f"((_b + 1) * {files} - 1) div {n_seqs}").alias("_g")).where("_f <= _g").collect()
    found = {f: (r[order_col], r["start"]) for r in rows for f in range(r["_f"], r["_g"] + 1)}
    return [found[f] for f in range(files)]


def _dealt(found: list[tuple], begins: list[int]):
    """Rows ``(file, key, bytes)`` of each document; ``begins``: the first id of
    each file and the end of the last."""
    keys = [k for k, _ in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            whole, files, cut = [], [], []
            for i, (key, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if not n:
                    continue
                # files lo to hi - 1 begin inside this document
                lo, hi = bisect_left(keys, key), bisect_right(keys, key)
                if lo == hi:
                    whole.append(i)
                    files.append(hi - 1)
                else:
                    cut.append((i, n, lo, hi))
            at = pa.array(whole, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.int32()), batch.column(0).take(at), batch.column(2).take(at)], names=ROUTED)
            for i, n, lo, hi in cut:
                ids, start = bytes_ids(batch.column(2)[i].as_py(), codec), found[lo][1]
                for f in range(max(lo - 1, 0), hi):
                    a, b = max(begins[f] - start, 0), min(begins[f + 1] - start, n)
                    if a < b:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([f], pa.int32()), batch.column(0).slice(i, 1),
                             pa.array([ids_bytes(ids.slice(a, b - a), codec)], pa.binary())], names=ROUTED)

    return run


ROUTED = ["_file", "_key", "_ids"]


def _joined(L: int, seqs: list[int]):
    """Sequences of the sorted rows of files; ``seqs``: the first sequence of
    each file and the number of all."""
    step = max(1, SLICE // 4 // L)  # sequences handed over at a time

    def out(seq: int, ids: pa.Array) -> pa.RecordBatch:
        n = len(ids) // L
        rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * L), ids)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(seq, seq + n)), rows], names=["seq_id", "input_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, file, seq, held, n = pa.Codec("zstd"), None, 0, [], 0

        def whole() -> None:
            if file is not None and seq != seqs[file + 1]:
                raise ValueError(f"the ids of file {file} end at sequence {seq}, not {seqs[file + 1]}")

        for batch in batches:
            for f, row in zip(batch.column(0).to_pylist(), batch.column(2)):
                if f != file:
                    whole()
                    file, seq, held, n = f, seqs[f], [], 0
                held.append(bytes_ids(row.as_py(), codec))
                n += len(held[-1])
                if n < step * L and n // L < seqs[f + 1] - seq:
                    continue
                ids = pa.concat_arrays(held)
                upto = min(n // L, seqs[f + 1] - seq)  # what the last file has beyond is the discarded tail
                for a in range(0, upto, step):
                    b = min(a + step, upto)
                    yield out(seq + a, pa.concat_arrays([ids.slice(a * L, (b - a) * L)]))
                seq, n = seq + upto, n - upto * L
                held = [pa.concat_arrays([ids.slice(upto * L)])]
        whole()

    return run


def packed_ranges(src: DataFrame, offsets: DataFrame, order_col: str, L: int, n_seqs: int, files: int) -> DataFrame:
    """``seq_id, input_ids`` of :func:`stored` rows in ``files`` partitions, each
    a contiguous range of sequences in order."""
    files = max(1, min(files, n_seqs))
    seqs = [f * n_seqs // files for f in range(files + 1)]
    found = borders(offsets, order_col, L, n_seqs, files)
    routed = T.StructType([T.StructField("_file", T.IntegerType()), T.StructField("_key", src.schema[order_col].dataType),
                           T.StructField("_ids", T.BinaryType())])
    return (
        src.select(order_col, "_n", "_ids")
        .mapInArrow(_dealt(found, [s * L for s in seqs]), routed)
        .repartitionById(files, F.col("_file"))
        .sortWithinPartitions("_file", "_key")
        .mapInArrow(_joined(L, seqs), "seq_id bigint, input_ids array<int>")
    )
