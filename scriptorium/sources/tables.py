"""Parquet tables of a data directory (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.session import spread

# Unique row keys of the tables the operators read; a narrow table is
# spread by hashing its key.
ROW_KEYS = {
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "pages": ["page_id"],
}


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The table, spread over the cores when its files give fewer partitions."""
    return spread(spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet"), key=ROW_KEYS.get(name))
