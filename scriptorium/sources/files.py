"""Files of a folder tree, listed and read in tasks.

Folders are listed level by level, each level a distributed pass over the one
before, so no listing passes through the driver. Files are read by the tasks
themselves, whole or in ranges of whole lines, and what cannot be listed or
read becomes a row with a reason instead of failing the job. Reading changes
nothing, so a task that runs again gives the same rows.

Names that start with ``.`` are left out, as a glob does.
"""

from __future__ import annotations

import functools
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import materialize, qualified

# an error that may pass is tried again, after a pause that doubles
ATTEMPTS, PAUSE_S = 3, 0.2
# a task reads about this many bytes
TASK_BYTES = 64 << 20
# characters that a task hands over at a time, and bytes it looks ahead for a line's end
BATCH_CHARS, CHUNK = 4 << 20, 1 << 16
MISSING, CHANGED, NOT_UTF8 = "missing", "changed after it was listed", "invalid utf-8"


@functools.lru_cache(maxsize=16)
def _file_system(base: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(base)


def open_store(path: str):
    """The file system of a qualified path, and the path in it. Only scheme
    and authority are parsed: a name may hold any character."""
    scheme, authority, place = re.fullmatch(r"([^:/]+)://([^/]*)(/.*)", path, re.S).groups()
    store, base = _file_system(f"{scheme}://{authority}/")
    return store, base.rstrip("/") + place


def _reason(exc: Exception) -> str:
    return MISSING if isinstance(exc, FileNotFoundError) else f"unreadable: {type(exc).__name__}"


def _tried(action: Callable):
    """``(result, reason)`` of ``action``, one of them None."""
    for attempt in range(ATTEMPTS):
        try:
            return action(), None
        except (FileNotFoundError, PermissionError, IsADirectoryError) as exc:
            return None, _reason(exc)
        except OSError as exc:
            if attempt + 1 == ATTEMPTS:
                return None, _reason(exc)
            time.sleep(PAUSE_S * 2 ** attempt)


LISTING = "path string, length long, folder boolean, reason string"


def _list_folders(suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for folder in batch.column(0).to_pylist():
                store, place = open_store(folder)
                found, reason = _tried(lambda: store.get_file_info(fs.FileSelector(place)))
                if reason:
                    rows.append((folder, None, False, reason))
                for info in found or ():
                    name = info.base_name
                    is_folder = info.type == fs.FileType.Directory
                    if not name.startswith(".") and (is_folder or name.endswith(suffix)):
                        rows.append((f"{folder}/{name}", info.size, is_folder, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.string(), pa.int64(), pa.bool_(), pa.string()))],
                names=["path", "length", "folder", "reason"])

    return run


def list_files(spark: SparkSession, root: str, suffix: str) -> tuple[DataFrame, DataFrame]:
    """Files below ``root`` whose names end in ``suffix`` (case-sensitive), as
    ``path, length``, and folders that could not be listed, as ``path,
    reason``. Raises ``FileNotFoundError`` if ``root`` does not exist."""
    from pyarrow import fs

    uri = qualified(spark, root.rstrip("/") or "/")
    store, place = open_store(uri)
    info = store.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"{root} does not exist")
    if info.type == fs.FileType.File:
        level = spark.createDataFrame([(uri, info.size, False, None)], LISTING)
        return level.select("path", "length"), level.where("false").select("path", "reason")
    level, levels = spark.createDataFrame([(uri, None, True, None)], LISTING), []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while not (folders := level.where("folder")).isEmpty():
        level = materialize(folders.select("path").repartition(parts, "path").mapInArrow(_list_folders(suffix), LISTING), "listing")
        levels.append(level)
    all_levels = levels[0]
    for level in levels[1:]:
        all_levels = all_levels.unionByName(level)
    return all_levels.where("not folder and reason is null").select("path", "length"), all_levels.where("reason is not null").select("path", "reason")


def _line_begin(f, at: int, length: int) -> int:
    """The first byte from ``at`` on with which a line starts (``length`` if
    none does); lines end with a line feed, a carriage return or both."""
    if at <= 0 or at >= length:
        return min(max(at, 0), length)
    place = at - 1
    while place < length:
        data = f.read_at(min(CHUNK, length - place), place)
        ends = [i for i in (data.find(b"\n"), data.find(b"\r")) if i >= 0]
        if ends:
            end = place + min(ends)
            if data[min(ends):][:1] == b"\r" and end + 1 < length and f.read_at(1, end + 1) == b"\n":
                end += 1
            return end + 1
        place += len(data)
    return length


def _read_lines(uri: str, start: int, end: int | None, length: int | None) -> tuple[bytes, bool]:
    """The lines that start in ``start:end``, and whether the file ends with
    them. Without a ``length`` the file is read as long as it is by now."""
    store, place = open_store(uri)
    with store.open_input_file(place) as f:
        if length is None:
            length = end = f.size()
        if f.size() != length:
            raise ValueError(CHANGED)
        lo, hi = _line_begin(f, start, length), _line_begin(f, end, length)
        return f.read_at(hi - lo, lo), hi == length and (hi > lo or not length)


READ = "text string, last boolean, reason string"


def _read_row(path: str, length: int | None, start: int, end: int | None) -> tuple[str | None, bool | None, str | None]:
    try:
        found, reason = _tried(lambda: _read_lines(path, start, end, length))
        if reason:
            return None, None, reason
        return found[0].decode().replace("\r\n", "\n").replace("\r", "\n"), found[1], None
    except UnicodeDecodeError:
        return None, None, NOT_UTF8
    except ValueError as exc:
        return None, None, str(exc)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, first, size = [], 0, 0
        for at, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4))), 1):
            rows.append(_read_row(*row))
            size += len(rows[-1][0] or "")
            if size >= BATCH_CHARS or at == batch.num_rows:
                kept = batch.slice(first, at - first)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.bool_(), pa.string())))],
                    names=[*batch.schema.names, "text", "last", "reason"])
                rows, first, size = [], at, 0


def ranges(files: DataFrame, piece_bytes: int | None = None) -> DataFrame:
    """``path, length, start, end, piece``: files in ranges of ``piece_bytes``
    (whole without it)."""
    whole = F.greatest(F.col("length"), F.lit(1))
    size = whole if piece_bytes is None else F.lit(piece_bytes).cast("long")
    pieces = files.withColumn("size", size).select(
        "path", "length", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(greatest(length, 1) - 1) div size"))).alias("piece"))
    return pieces.select("path", "length", (F.col("piece") * F.col("size")).alias("start"),
                         F.least((F.col("piece") + 1) * F.col("size"), F.col("length")).alias("end"), "piece")


def read_ranges(pieces: DataFrame) -> DataFrame:
    """``pieces`` (``path, length, start, end`` and any other columns) with the
    ``text`` of the lines that start in each range, whether the file ends with
    it (``last``), and the ``reason`` why it could not be read.

    Strict UTF-8, universal newlines. Ranges are dealt to tasks by a hash, so
    that the ranges of a long file are read side by side.
    """
    spark = pieces.sparkSession
    size = pieces.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    rest = [c for c in pieces.columns if c not in ("path", "length", "start", "end")]
    slim = pieces.select("path", "length", "start", "end", *rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema) + ", " + READ
    return slim.repartition(parts, "path", "start").mapInArrow(_read, schema)


def read_listed(paths: DataFrame) -> DataFrame:
    """``path, text, reason`` of whole files, as :func:`read_files`, but read
    where their names (``path``) are and as long as they are by now: narrow, so
    that it also runs on a stream."""
    whole = paths.select("path", F.lit(None).cast("long").alias("length"), F.lit(0).cast("long").alias("start"),
                         F.lit(None).cast("long").alias("end"))
    return whole.mapInArrow(_read, f"path string, length long, start long, end long, {READ}").select("path", "text", "reason")


def read_files(files: DataFrame) -> DataFrame:
    """``path, text, reason`` of whole files; one of ``text`` and ``reason`` is
    null."""
    return read_ranges(ranges(files)).select("path", "text", "reason")
