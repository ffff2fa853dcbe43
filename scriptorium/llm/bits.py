"""Bit tables of bounded size: what a set of hashes certainly does not hold.

A table is written to the shared folder in tasks, a block by one, and read by
workers. It has a bit for every value of the leading bits of a hash. It grows
with the set up to ``2 ** BITS_MOST`` bits; beyond, it lets more through, but
never stops a hash that was put in.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.shared import qualified, read_bytes, write_bytes
from scriptorium.session import materialize, scratch_path

# bits for each hash, and in all
BITS_EACH, BITS_LEAST, BITS_MOST, BLOCK_BITS = 32, 20, 29, 23


class Table(NamedTuple):
    """The logarithm of a table's bits, and ``(block, file)`` of its blocks."""

    bits: int
    files: tuple[tuple[int, str], ...]


def _write_blocks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            bit = batch.column(0).to_numpy()
            for block in np.unique(bit >> BLOCK_BITS).tolist():
                table = blocks.setdefault(block, np.zeros(1 << BLOCK_BITS - 3, np.uint8))
                own = bit[bit >> BLOCK_BITS == block] & (1 << BLOCK_BITS) - 1
                np.bitwise_or.at(table, own >> 3, (1 << (own & 7)).astype(np.uint8))
        for block, table in blocks.items():
            yield pa.RecordBatch.from_pylist([{"block": block, "file": write_bytes(f"{folder}/{block:04d}", table.tobytes())}])

    return run


def write(hashes: DataFrame) -> Table:
    """A table of the column ``h`` (64 bits; repeated ones are fine)."""
    spark = hashes.sparkSession
    bits = min(max((BITS_EACH * hashes.count()).bit_length(), BITS_LEAST), BITS_MOST)
    folder = qualified(spark, scratch_path(spark, "bits"))
    blocks = 1 << max(0, bits - BLOCK_BITS)
    place = f"shiftrightunsigned(h, {64 - bits})"
    files = materialize(
        hashes.select(F.expr(place).alias("bit"), F.expr(f"{place} div {1 << BLOCK_BITS}").alias("block"))
        .repartition(blocks, "block").select("bit").mapInArrow(_write_blocks(folder), "block long, file string"), "bit-blocks")
    return Table(bits, tuple(sorted((r["block"], r["file"]) for r in files.collect())))


@functools.lru_cache(maxsize=2)
def load(table: Table) -> np.ndarray:
    out = np.zeros(1 << max(table.bits, BLOCK_BITS) - 3, np.uint8)
    for block, file in table.files:
        at = block << BLOCK_BITS - 3
        out[at:at + (1 << BLOCK_BITS - 3)] = np.frombuffer(read_bytes(file), np.uint8)
    return out[:1 << table.bits - 3]


def held(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False for hashes that were not put into the loaded table."""
    bit = h >> np.uint64(64 - (len(table).bit_length() + 2))
    return (table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
