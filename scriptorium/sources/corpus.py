"""Corpus directories of ``.txt`` books.

* every ``*.txt`` (case-sensitive suffix) under the root, recursively, listed
  and read in tasks (:mod:`scriptorium.sources.files`);
* strict UTF-8: a file that does not decode, or cannot be read, is skipped and
  reported in an audit DataFrame instead of being read with replacement
  characters or failing the load;
* universal newlines (``\\r\\n`` and lone ``\\r`` become ``\\n``), BOM kept;
* the book name is the file name without its last extension;
* a name seen in several directories keeps the position of its first
  decodable path (sorted path order) and the text of its last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.ordering import global_row_index
from scriptorium.session import materialize
from scriptorium.sources.files import list_files, read_files


def scan_corpus(spark: SparkSession, corpus_dir: str) -> tuple[DataFrame, DataFrame]:
    """Files ``path, length`` of every ``*.txt`` under ``corpus_dir``, and the
    folders that could not be listed as ``path, reason``."""
    return list_files(spark, corpus_dir, ".txt")


def decode_files(files: DataFrame, observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(decoded ``path, text``, audit ``path, reason``); the files are read
    once and their texts written, so that both agree. ``observation``
    (optional) receives the counts ``files`` and ``undecodable`` of that pass."""
    read = read_files(files)
    if observation is not None:
        read = read.observe(observation, F.count(F.lit(1)).alias("files"), F.count("reason").alias("undecodable"))
    read = materialize(read, "decoded")
    return read.where("reason is null").select("path", "text"), read.where("reason is not null").select("path", "reason")


def book_name(path) -> F.Column:
    """File name without its last extension (``a.b.txt`` -> ``a.b``)."""
    return F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1)


def resolve_names(paths: DataFrame) -> DataFrame:
    """One row per name: ``name, first_path, path`` (dict-overwrite rule), from
    the paths alone: the first gives the position, the last the text."""
    named = paths.select("path", book_name(F.col("path")).alias("name"))
    return named.groupBy("name").agg(F.min("path").alias("first_path"), F.max("path").alias("path"))


def load_books(spark: SparkSession, corpus_dir: str, with_ord: bool = True,
               observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """``(books, audit)``; books are ``ord, name, text`` in load order, the
    audit ``path, reason`` of files and folders that could not be read.

    Every file is read once and its text written without a shuffle. Names and
    positions are settled on the paths; the texts of the winners are then
    fetched by path, in one join that moves no text if the paths are few
    enough for Spark to broadcast, and each text once if not. ``ord`` is a
    dense 0-based position; with ``with_ord=False`` the books are ``first_path,
    name, text`` and ``first_path`` itself is the order key (what packing
    needs). Raises ``FileNotFoundError`` when no ``.txt`` file exists at all; a
    corpus whose files all fail to decode yields an empty table.
    """
    try:
        files, lost = scan_corpus(spark, corpus_dir)
    except FileNotFoundError as exc:
        raise FileNotFoundError(f"No .txt files found under {corpus_dir}") from exc
    if files.isEmpty() and lost.isEmpty():
        raise FileNotFoundError(f"No .txt files found under {corpus_dir}")
    texts, audit = decode_files(files, observation)
    winners = resolve_names(texts.select("path"))
    if with_ord:
        winners = global_row_index(winners, ["first_path"], "ord")
    else:
        winners = materialize(winners, "winners")
    books = texts.join(winners, "path").select("ord" if with_ord else "first_path", "name", "text")
    return books, audit.unionByName(lost)


def load_stats(books: DataFrame) -> DataFrame:
    """Per book: name and character count."""
    return books.select("name", F.length("text").cast("bigint").alias("n_chars"))


def dataset_totals(books: DataFrame, text_col: str = "text") -> DataFrame:
    """Book count and total characters (one row)."""
    return books.agg(
        F.count(F.lit(1)).cast("bigint").alias("books"),
        F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("bigint").alias("total_chars"),
    )
