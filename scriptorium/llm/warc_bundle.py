"""WARC records in seekable Zstandard bundles.

Records are grouped into independent frames; a skippable frame at the end of
a bundle holds the seek table of the public seekable format (compressed and
uncompressed size of every frame). The index maps a record to its bundle, its
frame and its place inside the frame, so one record costs one frame.

Of pages with equal payloads the one with the smallest id is stored in full,
the others as ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.shared import Writer, _open, freeing, qualified
from scriptorium.session import materialize, scratch_path

FRAME_BYTES = 1 << 18
LEVEL = 3
# Fixed values of the seekable Zstandard and WARC formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64())])
INDEX = pa.schema([
    ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int64()),
    ("offset", pa.int64()), ("length", pa.int64())])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, copy: int = 0) -> str:
    name = "none" if page_id is None else str(page_id)
    return f"urn:page:{name}" + (f":{copy}" if copy else "")


def _header_text(value: str) -> str:
    """No control characters in a header line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def make_record(name: str, url: str, payload: bytes, date: str, refers_to: str | None = None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to else http + payload
    lines = [f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if url:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC headers, HTTP headers and payload of each record in ``data``."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        headers = _headers(data[at:head_end])
        block_at = head_end + 4
        end = block_at + int(headers["Content-Length"])
        http_end = data.index(b"\r\n\r\n", block_at)
        yield headers, _headers(data[block_at:http_end]), data[http_end + 4:end]
        at = end + 4


class BundleWriter:
    def __init__(self, uri: str):
        self._out = Writer(uri)
        self._packer = zstandard.ZstdCompressor(level=LEVEL)
        self._records: list[bytes] = []
        self._size = 0
        self._frames: list[tuple[int, int]] = []
        self.uri = uri

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset in the frame, and length of the record."""
        if self._size and self._size + len(record) > FRAME_BYTES:
            self._flush()
        place = len(self._frames), self._size, len(record)
        self._records.append(record)
        self._size += len(record)
        return place

    def _flush(self) -> None:
        packed = self._packer.compress(b"".join(self._records))
        self._out.write(packed)
        self._frames.append((len(packed), self._size))
        self._records, self._size = [], 0

    def close(self) -> None:
        if self._size:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self._frames)
        table += struct.pack("<IBI", len(self._frames), 0, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self._out.close()


class Bundle:
    """A bundle's seek table and frames."""

    def __init__(self, uri: str):
        store, path = _open(uri)
        self._file = store.open_input_file(path)
        size = self._file.size()
        n, _, magic = struct.unpack("<IBI", self._file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        table = self._file.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, plain))
            at += packed
        self._unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return self._unpacker.decompress(self._file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
        """One record, by its place in the index."""
        return next(parse_records(self.frame(frame)[offset:offset + length]))


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bundle, last, seen, copy = None, object(), {}, 0
        for batch in freeing(batches):
            rows = []
            for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None:
                    bundle = BundleWriter(f"{folder}/bundle-{TaskContext.get().partitionId():06d}.warc.zst")
                payload = (html or "").encode()
                # rows of one page come together; a second one of the same payload revisits the first
                copy, seen = (copy + 1, seen) if page_id == last else (0, {})
                last = page_id
                name, key = record_id(page_id, copy), hashlib.sha1(payload).digest()
                target = record_id(first) if first is not None and first != page_id else None
                if target is None and first is not None:
                    target = seen.get(key)
                    seen.setdefault(key, record_id(first))
                place = bundle.add(make_record(name, url or "", payload, date, target))
                rows.append((name, bundle.uri, *place))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)
        if bundle is not None:
            bundle.close()

    return run


def write_bundles(
    pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Write the bundles and return the index ``(record_id, bundle, frame,
    offset, length)``, one row per page.

    Null payloads and urls count as empty. Payloads are equal when length and
    SHA-256 are; those under ``min_revisit_bytes`` are always stored in full.
    Rows with a null id are always stored in full, and nothing refers to them.
    Of repeated rows (one id, one payload) the first is the record that the
    others revisit; rows of one id with other payloads get a number behind
    their record id, and others refer to the smallest id. Control characters
    in a url are percent-encoded. An empty table writes no bundle.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html"))
    size = F.octet_length("html")
    slim = materialize(
        rows.where((size >= min_revisit_bytes) & F.col("page_id").isNotNull())
        .select("page_id", F.sha2("html", 256).alias("digest"), size.alias("bytes")), "warc-digests")
    shared = (
        slim.groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    firsts = slim.join(shared, ["digest", "bytes"]).groupBy("page_id", "digest").agg(F.min("first").alias("first"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # payloads are dealt out once, by page: equality of digests, as long as each
    # other, is put so that it does not become a key of the join
    dealt = rows.repartition(parts, "page_id").withColumn("digest", F.sha2("html", 256)).alias("r")
    same = (F.col("r.page_id") == F.col("f.page_id")) & F.contains("r.digest", "f.digest")
    linked = dealt.join(firsts.alias("f"), same, "left").select("r.page_id", "r.url", "r.html", "f.first")
    placed = linked.sortWithinPartitions("page_id", "html", "url")
    return materialize(placed.mapInArrow(
        _write(folder, date), "record_id string, bundle string, frame long, offset long, length long"), "warc-index")


def _page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in freeing(batches):
        for uri in batch.column(0).to_pylist():
            bundle = Bundle(uri)
            for number in range(len(bundle.frames)):
                rows = []
                for warc, http, payload in parse_records(bundle.frame(number)):
                    digest, size = warc["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
                    refers = None
                    if warc["WARC-Type"] == "revisit":
                        refers = _page_of(warc["WARC-Refers-To"])
                    elif (len(payload), payload_digest(payload)) != (size, digest):
                        raise ValueError(f"{warc['WARC-Record-ID']} in {uri} is damaged")
                    rows.append((_page_of(warc["WARC-Record-ID"]), size, digest, warc["WARC-Type"], refers))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)


def read_bundles(index: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of
    every record in the bundles of an index; payloads are checked."""
    bundles = index.select("bundle").distinct()
    parts = max(1, bundles.count())
    return bundles.repartitionByRange(parts, "bundle").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
