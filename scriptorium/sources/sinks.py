"""Dataset sinks: packed sequences, split examples, run manifests, text files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import qualified, scratch_path
from scriptorium.sources.files import open_store

PACKED_SCHEMA = "seq_id bigint, input_ids array<int>, labels array<int>"


def write_packed(packed: DataFrame, path: str | None = None, mode: str = "overwrite",
                 ordered: bool = False) -> str:
    """Write packed sequences as Parquet, with the order key ``seq_id`` stored.

    By default each file is sorted by ``seq_id`` without another shuffle;
    ``ordered=True`` range-partitions first so every file holds one
    contiguous block (a full extra shuffle of the tokens, only worth it for
    readers that stream files in order).
    """
    path = path or scratch_path(packed.sparkSession, "packed")
    out = packed
    if ordered:
        n = max(1, packed.sparkSession.sparkContext.defaultParallelism)
        out = out.repartitionByRange(n, "seq_id")
    out.sortWithinPartitions("seq_id").write.mode(mode).parquet(path)
    return path


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACKED_SCHEMA).parquet(path)


INDEX = "file string, first_seq bigint, last_seq bigint, sequences bigint, digest bigint"


def _row_digest() -> Column:
    return F.xxhash64("seq_id", "input_ids", "labels")


# ids that one task sorts and writes into a file
FILE_IDS = 16 << 20
# sequences of a row group: Spark's reader holds the ids, labels and levels of up to 4096 at once
GROUP_ROWS = 512


def file_count(files: int, n_ids: int) -> int:
    """``files``, or as many more as ``n_ids`` need at about ``FILE_IDS`` each."""
    return max(files, -(-n_ids // FILE_IDS))


def write_indexed(packed: DataFrame, path: str | None = None, files: int | None = None, n_ids: int | None = None,
                  ranged: bool = False) -> str:
    """Packed sequences in files of contiguous ``seq_id`` with an index beside
    them (``path`` + ``.index``): a file's name, first and last sequence, rows
    and an order-free digest of its rows, taken from what was written.

    A file is one task's share. ``n_ids``, the ids of all sequences, raises
    ``files`` so that none has more than about ``FILE_IDS``. ``ranged`` says
    that the partitions are such ranges in order already (``ranges`` of
    ``pack_counted``) and a file each; nothing is shuffled then.
    """
    spark = packed.sparkSession
    path = path or scratch_path(spark, "packed-indexed")
    if not ranged:
        n = file_count(files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), n_ids or 0)
        packed = packed.repartitionByRange(n, "seq_id").sortWithinPartitions("seq_id")
    packed.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)
    rows = read_packed(spark, path).select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
    rows.groupBy("file").agg(
        F.min("seq_id").alias("first_seq"), F.max("seq_id").alias("last_seq"), F.count(F.lit(1)).alias("sequences"),
        F.bit_xor(_row_digest()).alias("digest")).coalesce(1).write.mode("overwrite").parquet(f"{path}.index")
    return path


def read_rank(spark: SparkSession, path: str, rank: int, world: int, verify: bool = False) -> DataFrame:
    """The sequences of trainer ``rank`` of ``world``: its files alone are
    opened, in order of their first sequence every ``world``-th of them. With
    ``verify`` a file whose rows differ from the index raises ``ValueError``.

    The index has a row per file; the driver reads it to name the files.
    """
    if not 0 <= rank < world:
        raise ValueError("rank must be from 0 to world - 1")
    index = spark.read.schema(INDEX).parquet(f"{path}.index").orderBy("first_seq").collect()[rank::world]
    if not index:
        return spark.createDataFrame([], PACKED_SCHEMA)
    own = spark.read.schema(PACKED_SCHEMA).parquet(*[f"{path}/{r['file']}" for r in index])
    if verify:
        found = own.agg(F.count(F.lit(1)), F.bit_xor(_row_digest())).first()
        want = 0
        for r in index:
            want ^= r["digest"]
        if tuple(found) != (sum(r["sequences"] for r in index), want):
            raise ValueError(f"files of rank {rank} under {path} differ from their index")
    return own


def write_split(examples: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> str:
    """Write examples partitioned by split (``split=train`` / ``split=eval``)."""
    examples.write.mode(mode).partitionBy(split_col).parquet(path)
    return path


def dataset_manifest(counts: DataFrame, **params) -> DataFrame:
    """A one-row manifest: the one-row ``counts`` (computed by Spark), the job
    parameters as literal columns, and a completion timestamp."""
    lits = [F.lit(v).alias(k) for k, v in params.items()]
    ts = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("completed_at")
    return counts.select(*lits, *counts.columns, ts)


def write_manifest(manifest: DataFrame, path: str, mode: str = "overwrite") -> str:
    manifest.coalesce(1).write.mode(mode).json(path)
    return path


def staged_folder(out: str) -> str:
    """A folder of its own for the outputs of one run under ``out``; they count
    only once :func:`commit_manifest` has named it."""
    return f"{out.rstrip('/')}/run-{uuid.uuid4().hex}"


def commit_manifest(manifest: DataFrame, out: str, staged: str) -> str:
    """Write the manifest of the run in ``staged``, the last output of a job:
    Spark's commit shows it whole or not at all, and readers find the data
    through it."""
    named = manifest.withColumn("data", F.lit(staged.rsplit("/", 1)[-1]))
    return write_manifest(named, f"{out.rstrip('/')}/manifest")


def open_run(spark: SparkSession, out: str) -> tuple[Row, str]:
    """The manifest of the last complete run under ``out`` and the folder of
    its data; ``FileNotFoundError`` if no run was completed."""
    try:
        rows = spark.read.json(f"{out.rstrip('/')}/manifest").head(1)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no complete run under {out}") from exc
    if not rows:
        raise FileNotFoundError(f"no complete run under {out}")
    return rows[0], f"{out.rstrip('/')}/{rows[0]['data']}"


def write_text_files(df: DataFrame, root: str, relpath_col: str = "relpath", text_col: str = "text",
                     encoding_col: str | None = None) -> DataFrame:
    """Write each row's text to ``root/<relpath>`` (one file per row).

    A corpus directory is one file per document, which no built-in writer
    produces; each task writes its own rows through Arrow's filesystem layer
    (local, HDFS or object stores by URI). Rewriting a file on a task retry
    gives the same bytes. ``encoding_col`` names a per-row Python codec
    (default UTF-8; unencodable characters become ``?``). Returns
    ``(relpath, bytes)`` per written file.
    """
    root = qualified(df.sparkSession, root).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_store(root)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            # a row at a time: the texts of a batch are never all in Python
            for row in zip(*batch.columns):
                rel, text, *codec = (x.as_py() for x in row)
                target = f"{base}/{rel}"
                parent = target.rsplit("/", 1)[0]
                if parent not in made:
                    filesystem.create_dir(parent, recursive=True)
                    made.add(parent)
                data = (text or "").encode((codec and codec[0]) or "utf-8", errors="replace")
                with filesystem.open_output_stream(target) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=[relpath_col, "bytes"])

    cols = [relpath_col, text_col] + ([encoding_col] if encoding_col else [])
    return df.select(*cols).mapInArrow(write, f"{relpath_col} string, bytes long")
