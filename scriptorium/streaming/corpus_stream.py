"""Incremental corpus preparation with Structured Streaming.

New ``.txt`` files landing in a folder are decoded (strict UTF-8),
newline-normalised, cleaned and tokenised as they arrive; each micro-batch
appends to a Parquet table. These steps are per-file and stateless, so the
stream needs no watermark or state store; the file source and the sink's
commit log (under ``checkpointLocation``) give exactly-once output across
restarts and executor loss. Undecodable files go to a second sink.

The folder is listed in tasks, and the names that no listing has yet are
appended to a Parquet table beside the checkpoints. That table is the source
of the streams: the driver knows its few files, not the books, and each task
reads the books it has the names of.

Steps that need the whole corpus (duplicate-name resolution, global order,
packing) stay batch jobs over the accumulated table.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptorium.functions import tokens as K
from scriptorium.operators import clean as C
from scriptorium.session import intermediates, qualified, ship_package, stream_location as default_location
from scriptorium.sources.corpus import book_name
from scriptorium.sources.files import MISSING, NOT_UTF8, TASK_BYTES, list_files, read_listed

TRIGGER_S = 30

LISTED = "path string, length long"
# names that Spark's own file source leaves out besides those with a leading "."
_HIDDEN = r"(^|/)_[^/=]*(/|$)|\._COPYING_$"


def list_new(spark: SparkSession, corpus_dir: str, listing: str) -> None:
    """Append the ``.txt`` files that ``listing`` does not have yet to it."""
    with intermediates(spark):
        files, lost = list_files(spark, corpus_dir, ".txt")
        bad = lost.where(F.col("reason") != MISSING).head(1)
        if bad:
            raise OSError(f"{bad[0]['path']}: {bad[0]['reason']}")
        below = F.substring(F.col("path"), len(qualified(spark, corpus_dir.rstrip("/") or "/")) + 1, 1 << 20)
        files = files.where(~below.rlike(_HIDDEN))
        try:
            files = files.join(spark.read.schema(LISTED).parquet(listing).select("path"), "path", "left_anti")
        except AnalysisException:  # nothing is listed yet
            pass
        size = files.agg(F.sum("length")).first()[0] or 0
        parts = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
        files.select("path", "length").repartition(parts, "path").write.mode("append").parquet(listing)


def read_corpus_stream(spark: SparkSession, listing: str) -> DataFrame:
    """``path, text, reason`` of the files that ``listing`` gets."""
    files = read_listed(spark.readStream.schema(LISTED).parquet(listing))
    known = F.col("reason").isNull() | F.col("reason").isin(NOT_UTF8, MISSING)
    held = F.assert_true(known, F.concat("path", F.lit(": "), "reason"))
    # as Spark's file source writes local paths
    return files.where(held.isNull()).withColumn("path", F.regexp_replace("path", "^file:///", "file:/"))


def clean_stream(files: DataFrame, tokenizer: str = "codepoints", missing_start: str = "empty") -> DataFrame:
    """``path, name, clean, input_ids`` for decodable files (stateless)."""
    decoded = files.where("reason is null").select("path", book_name(F.col("path")).alias("name"), "text")
    cleaned = C.clean_corpus(decoded, "text", "clean", missing_start).drop("text")
    enc = K.codepoint_ids if tokenizer == "codepoints" else K.bpe_encoder(tokenizer)
    return cleaned.withColumn("input_ids", enc(F.col("clean")))


def rejected_stream(files: DataFrame) -> DataFrame:
    return files.where("reason is not null").select("path", "reason")


def _keep_listing(spark: SparkSession, corpus_dir: str, listing: str, queries: tuple[StreamingQuery, ...]) -> None:
    """List the folder again while the streams run; a listing that fails ends them."""
    try:
        while not queries[0].awaitTermination(TRIGGER_S) and queries[1].isActive:
            list_new(spark, corpus_dir, listing)
    finally:
        for q in queries:
            q.stop()


def start_corpus_stream(spark: SparkSession, corpus_dir: str, output_dir: str,
                        checkpoint_location: str | None = None, tokenizer: str = "codepoints",
                        available_now: bool = True) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the cleaned-output and audit streams; returns both handles.

    ``checkpoint_location`` defaults to a folder under ``spark.checkpoint.dir``
    that belongs to these two folders.
    With ``available_now`` the streams process what is there and stop.
    """
    ship_package(spark)
    ckpt = (checkpoint_location or default_location(spark, "corpus", corpus_dir, output_dir)).rstrip("/")
    listing = f"{ckpt}/files"
    list_new(spark, corpus_dir, listing)
    files = read_corpus_stream(spark, listing)

    def start(df: DataFrame, sub: str) -> StreamingQuery:
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{ckpt}/{sub}")
             .option("path", f"{output_dir.rstrip('/')}/{sub}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{TRIGGER_S} seconds")
        return w.start()

    queries = start(clean_stream(files, tokenizer), "cleaned"), start(rejected_stream(files), "rejected")
    if not available_now:
        threading.Thread(target=_keep_listing, args=(spark, corpus_dir, listing, queries), daemon=True).start()
    return queries
