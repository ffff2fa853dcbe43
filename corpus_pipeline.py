"""The corpus pipeline: quality, toxicity, near duplicates, decontamination,
packing, each stage on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import length_buckets, minhash_tensor, quality, suffix_decontam, toxicity
from scriptorium.llm.queries import LENGTH_BUCKETS, TOKEN_BUDGET, token_count, training_labels
from scriptorium.session import materialize, ship_package

WORDS_PER_SHINGLE, PERCENT, WINDOW = 5, 80, 10


def _table(docs: DataFrame, sf_dir: str, name: str) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.sparkSession.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rating is 1 or better with a probability of 0.5 or more."""
    model = quality.train(docs, training_labels(_table(docs, sf_dir, "labels")))
    return quality.select_good(docs, model, grade=1, threshold=0.5)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.5."""
    model = toxicity.train(docs, training_labels(_table(docs, sf_dir, "labels")))
    return toxicity.remove_toxic(docs, model, threshold=0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id;
    rows of one id with different texts are in the groups of their texts."""
    ship_package(spark)
    return minhash_tensor.remove_duplicates(docs, words_per_shingle=WORDS_PER_SHINGLE, percent=PERCENT)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return suffix_decontam.remove_contaminated(docs, _table(docs, sf_dir, "benchmark"), window=WINDOW)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in length buckets and batches."""
    ship_package(spark)
    return length_buckets.pack(token_count(docs), TOKEN_BUDGET, LENGTH_BUCKETS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("toxicity", keep_civil),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("packing", pack),
]

# trained models and a tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
