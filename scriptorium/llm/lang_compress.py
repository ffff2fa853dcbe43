"""Language identification by compression.

Every language has a raw-content zstd dictionary: lines of a bounded sample of
its documents. A text is encoded with each dictionary, block by block, and is
said to be in the language that makes it smallest; where the runner-up is
nearly as small, the answer is rejected.

Lines that the sample has under more than one language (licences, passages
that documents share) tell nothing: they stand at the end of every dictionary
alike, so that they cost the same in each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import _open, freeing, qualified
from scriptorium.llm.textbytes import slices, utf8
from scriptorium.session import materialize, scratch_path

# a language's dictionary is made from this many different documents at most, and has so many bytes,
# up to SHARED_BYTES of them lines that languages share
SAMPLE_DOCS, DICTIONARY_BYTES, SHARED_BYTES = 500, 1 << 16, 1 << 14
# longer lines enter the sample in pieces of so many characters
LINE_CHARS = 512
# texts are encoded in blocks, so that the dictionary counts as much at a long text's end as at its start
BLOCK_BYTES, LEVEL = 1024, 6
# zstd keeps a block as it is where it saves too little; a run before it makes the shortest text worth encoding
LEAD = b" " * 64
# the runner-up must be larger by this share
MARGIN = 0.01
UNKNOWN = "und"


def folded(text: str | Column) -> Column:
    """Texts as the dictionaries see them."""
    return F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> str:
    """Build the dictionaries from all of ``docs`` with a language, and store
    them in the shared folder; returns the folder.

    A language's sample is the ``SAMPLE_DOCS`` different texts with the
    smallest hashes, whole; its dictionary takes lines of the whole sample in
    the order of their hashes. Rows with a null language, and null or empty
    texts, take no part; repeated texts count once. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), folded(text_col).alias("text")).where("lang is not null and text <> ''")
    marked = texts.withColumn("h", F.xxhash64("text"))
    # two levels: the limits apply before each shuffle, so no language is gathered in one task
    slim = marked.select("lang", "h", (F.spark_partition_id() % 64).alias("salt")).distinct()

    def first(rows: DataFrame, *key: str) -> DataFrame:
        order = Window.partitionBy(*key).orderBy("h")
        return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE_DOCS).drop("at")

    # written, so that Spark knows its size and broadcasts it only if it is small
    chosen = materialize(first(first(slim, "lang", "salt").select("lang", "h").distinct(), "lang"), "language-sample")
    sample = marked.join(chosen, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    lines = F.regexp_extract_all("text", F.lit(rf"(\S.{{0,{LINE_CHARS - 1}}})"), 1)
    units = (
        sample.select("lang", F.explode(lines).alias("line")).groupBy("line")
        .agg(F.min("lang").alias("lang"), F.max("lang").alias("other"))
        .select("line", F.when(F.col("lang") == F.col("other"), F.col("lang")).alias("lang"), F.xxhash64("line").alias("h"))
    )
    size = F.sum(F.octet_length("line") + 1).over(Window.partitionBy("lang").orderBy("h", "line"))
    room = F.when(F.col("lang").isNull(), SHARED_BYTES).otherwise(DICTIONARY_BYTES - SHARED_BYTES)
    held = units.withColumn("size", size).where(F.col("size") <= room)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("h", "line"))), lambda u: u["line"]), "\n")
    content = materialize(held.groupBy("lang").agg(joined.alias("content")), "dictionaries")
    # one row of at most SHARED_BYTES
    shared = [r["content"] for r in content.where("lang is null").collect()]
    content = content.withColumn("content", F.concat_ws("\n", "content", *map(F.lit, shared)))
    counts = texts.groupBy("lang").agg(F.count("*").alias("docs"))
    folder = qualified(spark, scratch_path(spark, "languages"))
    counts.join(content, "lang", "left").select("lang", "docs", F.coalesce("content", F.lit("\n".join(shared))).alias("content")) \
        .coalesce(1).write.parquet(folder)
    return folder


class Dictionaries:
    """One compressor a language; of equal sizes the language with more
    training documents wins, then the smaller name."""

    def __init__(self, rows: list[dict]):
        rows = sorted(rows, key=lambda r: (-r["docs"], r["lang"]))
        self.languages = [r["lang"] for r in rows]
        self._packers = [self._packer(r["content"].encode()) for r in rows]

    @staticmethod
    def _packer(content: bytes) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=BLOCK_BYTES, dict_size=max(len(content), 8),
            write_content_size=False, write_checksum=False, write_dict_id=False)
        if len(content) < 8:  # zstd takes no shorter dictionary
            return zstandard.ZstdCompressor(compression_params=params)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=params)

    def sizes(self, text: bytes) -> list[int]:
        """Encoded bytes of a text under each language."""
        blocks = [LEAD + text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
        return [sum(len(p.compress(b)) for b in blocks) for p in self._packers]


@functools.lru_cache(maxsize=1)
def _dictionaries(folder: str) -> Dictionaries:
    store, path = _open(folder)
    return Dictionaries(pq.ParquetDataset(path, filesystem=store).read().to_pylist())


def _judge(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest column, its share of all (halved with each byte more) and the
    runner-up's distance as a share of it, by row."""
    best = np.argmin(sizes, axis=1)
    least = sizes[np.arange(len(sizes)), best]
    weight = np.exp2(-np.minimum(sizes - least[:, None], 1000).astype(float))
    if sizes.shape[1] == 1:
        return best, np.ones(len(best)), np.ones(len(best))
    second = np.partition(sizes, 1, axis=1)[:, 1]
    return best, 1 / weight.sum(1), (second - least) / np.maximum(second, 1)


def identify(docs: DataFrame, model: str, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, best, score, margin, language`` of every row, from its whole
    text alone.

    ``best`` is the language of the smallest encoding, ``score`` (0 to 1) its
    share, ``margin`` by what share of its size the runner-up is larger;
    ``language`` is ``best`` unless the margin is narrower than ``margin``,
    then ``und``. A text that is null or has no letter is ``und`` with score
    0 in both, and so is every text without a language to choose from.
    Repeated rows are judged each; other columns are ignored; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _dictionaries(model)
        names = pa.array([*held.languages, UNKNOWN], pa.string())
        for batch in freeing(batches):
            buf, off = utf8(batch.column(1))
            raw = memoryview(buf)
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, hi in slices(off):
                out = np.full(hi - lo, len(held.languages))
                score, gap = np.zeros(hi - lo), np.zeros(hi - lo)
                rows = np.flatnonzero(lettered[lo:hi]) if held.languages else np.empty(0, np.int64)
                if len(rows):
                    sizes = np.array([held.sizes(bytes(raw[off[lo + i]:off[lo + i + 1]])) for i in rows.tolist()])
                    out[rows], score[rows], gap[rows] = _judge(sizes)
                best = names.take(pa.array(out))
                sure = np.where(gap >= margin, out, len(held.languages))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), best, pa.array(score), pa.array(gap), names.take(pa.array(sure))],
                    names=["doc_id", "best", "score", "margin", "language"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), folded(F.col(text_col).cast("string")).alias("text"),
        F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, "doc_id long, best string, score double, margin double, language string")
