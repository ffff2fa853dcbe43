"""Token-id files: every document is one zstd frame under a shared dictionary.

The dictionary is trained on serialized id arrays of a bounded sample; the
files keep its hash and, behind the frames, an index of documents, so that a
short document is read without touching its neighbours.

File: ``MAGIC``, id bytes (u8), dictionary sha256 (32 bytes); the frames in
ascending ``doc_id``, those with a null id first; the index, 32 bytes a
document: ``doc_id`` (i64), frame offset, frame bytes, ids (u64 each); index
offset, documents and how many of them have a null id (u64 each), ``MAGIC``.
All little-endian.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.shared import Writer, _open, freeing, qualified, read_bytes, sole, write_bytes
from scriptorium.llm.textbytes import byte_class, slices, split_words, utf8, word_array
from scriptorium.session import materialize, scratch_path

MAGIC = b"IDS1"
HEAD_BYTES, TAIL_BYTES = 4 + 1 + 32, 8 + 8 + 8 + 4
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("bytes", "<u8"), ("ids", "<u8")])
# the dictionary is fitted on so many documents, in pieces of so many bytes, on as many pieces
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 1 << 15, 1 << 16
FILE_BYTES = 64 << 20
CACHE_WORDS = 300_000
WORD_BYTES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")


def _strings(spec) -> set[str]:
    """All strings in a part of a tokenizer's description."""
    if isinstance(spec, dict):
        spec = list(spec.values())
    return set().union(*map(_strings, spec)) if isinstance(spec, list) else {spec} if isinstance(spec, str) else set()


_LETTER, _DIGIT, _SIGN, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER


def plain_pieces(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words`` with each plain one (ASCII and Latin-1 letters, digits, signs;
    no apostrophe, no ``<|``) in lower case and cut into runs of letters, single
    digits and runs of signs; and the byte at which each piece starts."""
    _, offsets, data = words.buffers()
    off = np.frombuffer(offsets, np.int64)[:len(words) + 1]
    held = np.frombuffer(data, np.uint8)[:off[-1]].copy()
    kind, after = _KIND[held], np.append(held[1:], 0)
    pair = np.flatnonzero((held == 0xC3) & (after >= 0x80) & (after != 0x97) & (after != 0xB7))
    kind[pair] = kind[pair + 1] = _LETTER
    odd = (kind == _OTHER) | (held == ord("'")) | ((held == ord("<")) & (after == ord("|")))
    before = np.concatenate([[0], np.cumsum(odd)])
    plain = np.repeat(before[off[1:]] == before[off[:-1]], np.diff(off))
    upper = plain & (held >= 65) & (held <= 90)
    upper[pair + 1] |= plain[pair] & (held[pair + 1] < 0x9F)
    held[upper] += 32
    starts = np.zeros(len(held), bool)
    starts[1:] = plain[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    starts[off[:-1]] = True
    at = np.flatnonzero(starts)
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(held))), pa.py_buffer(held)]), at


class WordEncoder:
    """A tokenizer that drops white space, applied to distinct words.

    Such a tokenizer treats the text between white space on its own, so ids of
    a text are the ids of its words in order. A word is looked up. New words of
    plain Latin letters, digits and punctuation are encoded many to a text and
    told apart by the ids that end a piece, as the pieces that the
    pre-tokenizer makes of each are known; any other word is encoded alone, and
    so are all where the vocabulary does not mark ends. Under the pre-tokenizer
    and lower case of ``_SPLIT``, plain words without an apostrophe are looked
    up piece by piece. The table is emptied when it holds ``CACHE_WORDS``
    words.
    """

    # Fixed value: the pre-tokenizer's pattern.
    _SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
    _PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~]+")
    _TOGETHER = 256

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        mark = spec["model"].get("end_of_word_suffix")
        self.by_piece = self._SPLIT in _strings(spec["pre_tokenizer"]) and "Lowercase" in _strings(spec["normalizer"])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if mark:
            self.ends[[i for token, i in vocab.items() if token.endswith(mark)]] = True
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def _pieces(self, word: str) -> int:
        """The pieces of a plain word; 0 for any other."""
        if word.isascii() and word.isalpha():
            return 1
        return len(self._PIECE.findall(word.lower())) if self._PLAIN.fullmatch(word) and "<|" not in word else 0

    def _together(self, words: list[str], pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`_encode` of plain words of so many pieces each."""
        step = self._TOGETHER
        ids, sizes = self._encode([" ".join(words[i:i + step]) for i in range(0, len(words), step)])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == pieces.sum():
            upto = ends[np.cumsum(pieces) - 1]
            if np.array_equal(np.append(upto[step - 1:-1:step], upto[-1:]), np.cumsum(sizes)):
                return ids, np.diff(upto, prepend=0)
        return self._encode(words)

    def _learn(self, words: list[bytes]) -> None:
        texts = b" ".join(words).decode().split(" ")
        pieces = np.fromiter(map(self._pieces, texts), np.int64, len(texts))
        plain, other = np.flatnonzero(pieces), np.flatnonzero(pieces == 0)
        at, used = len(self.slot), len(self.ids)
        for rows, (ids, counts) in (
            (plain, self._together([texts[i] for i in plain.tolist()], pieces[plain])),
            (other, self._encode([texts[i] for i in other.tolist()])),
        ):
            self.slot.update(zip([words[i] for i in rows.tolist()], range(at, at + len(rows))))
            self.start = np.append(self.start, used + np.cumsum(counts) - counts)
            self.count = np.append(self.count, counts)
            self.ids = np.append(self.ids, ids)
            at, used = at + len(rows), used + len(ids)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts (offsets ``off`` into ``buf``), joined, and how
        many each text has. Only the different words of all texts are looked
        up, one by one."""
        if len(self.slot) > CACHE_WORDS:
            self._clear()
        w = split_words(buf, off, WORD_BYTES)
        units = word_array(w, fold_case=False)
        first = w.first
        if self.by_piece and len(units):
            units, at = plain_pieces(units)
            first = np.searchsorted(at, np.concatenate([[0], np.cumsum(w.end - w.start)])[w.first])
        coded = units.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [x for x in words if x not in self.slot]
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        n = self.count[slots]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.start[slots] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, np.diff(upto[first])


def _load_encoder(uri: str) -> WordEncoder:
    return WordEncoder(read_bytes(uri).decode())


def _encoder(uri: str) -> WordEncoder:
    return sole(_load_encoder, uri)


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def _ids_of(batch: pa.RecordBatch, encoder: WordEncoder, end_id: int, dtype) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By slices of documents: the first one's row, the ids of all with the
    end id behind each, and how many each has."""
    buf, off = utf8(batch.column(1))
    for lo, hi in slices(off):
        ids, counts = encoder.encode(buf, off[lo:hi + 1])
        yield lo, np.insert(ids, np.cumsum(counts), end_id).astype(dtype), counts + 1


def _packed(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The serialized ids of each document."""
    raw, ends = ids.tobytes(), np.cumsum(counts) * ids.itemsize
    return [raw[e - n:e] for e, n in zip(ends.tolist(), (counts * ids.itemsize).tolist())]


def _samples(tokenizer: str, end_id: int, dtype: str):
    def run(batches):
        for batch in freeing(batches):
            for _, ids, counts in _ids_of(batch, _encoder(tokenizer), end_id, dtype):
                pieces = [d[i:i + SAMPLE_BYTES] for d in _packed(ids, counts) for i in range(0, len(d), SAMPLE_BYTES)]
                yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["ids"])

    return run


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstd dictionary; too little data gives one of the samples as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _frames(tokenizer: str, dictionary: str, end_id: int, dtype: str):
    def run(batches):
        raw = read_bytes(dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(raw) if raw else None)
        for batch in freeing(batches):
            ids = batch.column(0).cast(pa.int64())
            for lo, found, counts in _ids_of(batch, _encoder(tokenizer), end_id, dtype):
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, len(counts)), pa.array(counts),
                    pa.array([packer.compress(d) for d in _packed(found, counts)], pa.binary()),
                ], names=["doc_id", "n_tokens", "frame"])

    return run


def _write_files(folder: str, digest: bytes, id_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        out, index, nulls = None, [], 0
        for batch in freeing(batches):
            if not batch.num_rows:
                continue
            if out is None:
                out = Writer(f"{folder}/part-{TaskContext.get().partitionId():06d}.ids")
                out.write(MAGIC + bytes([id_bytes]) + digest)
            entry = np.zeros(batch.num_rows, ENTRY)
            nulls += batch.column(0).null_count
            entry["doc_id"] = batch.column(0).fill_null(0).to_numpy()
            entry["ids"] = batch.column(1).to_numpy()
            _, offsets, data = batch.column(2).cast(pa.large_binary()).buffers()
            at = np.frombuffer(offsets, np.int64)[batch.column(2).offset:][:batch.num_rows + 1]
            entry["bytes"] = np.diff(at)
            entry["offset"] = out.size + at[:-1] - at[0]
            out.write(memoryview(data)[at[0]:at[-1]])
            index.append(entry)
        if out is not None:
            index = np.concatenate(index)
            start = out.size
            out.write(index.tobytes())
            out.write(np.array([start, len(index), nulls], "<u8").tobytes() + MAGIC)
            yield pa.RecordBatch.from_pylist([{
                "file": out.close(), "part": TaskContext.get().partitionId(),
                "n_docs": len(index), "n_tokens": int(index["ids"].sum())}])

    return run


class IdFile:
    """Reads one file; ``dictionary`` is checked against the stored hash."""

    def __init__(self, uri: str, dictionary: bytes):
        store, path = _open(uri)
        self._file = store.open_input_file(path)
        head, size = self._file.read_at(HEAD_BYTES, 0), self._file.size()
        tail = self._file.read_at(TAIL_BYTES, size - TAIL_BYTES)
        if head[:4] != MAGIC or tail[-4:] != MAGIC:
            raise ValueError(f"{uri} is not a complete id file")
        if head[5:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.dtype = np.dtype(f"<u{head[4]}")
        start, n, self.nulls = np.frombuffer(tail[:24], "<u8").tolist()
        self.index = np.frombuffer(self._file.read_at(n * ENTRY.itemsize, start), ENTRY)
        self._unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary) if dictionary else None)

    def ids(self, row: int) -> np.ndarray:
        """Ids of one document, by its row in the index."""
        entry = self.index[row]
        return self._ids(self._file.read_at(int(entry["bytes"]), int(entry["offset"])))

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self._unpacker.decompress(frame), self.dtype)

    def document(self, doc_id: int) -> np.ndarray | None:
        """Ids of a document by its id; None if it is not in this file."""
        row = self.nulls + int(np.searchsorted(self.index["doc_id"][self.nulls:], doc_id))
        return self.ids(row) if row < len(self.index) and self.index["doc_id"][row] == doc_id else None

    def documents(self, block: int = 4 << 20) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, read about ``block`` bytes at a time."""
        ends = (self.index["offset"] + self.index["bytes"]).astype(np.int64)
        lo = 0
        while lo < len(self.index):
            base = int(self.index["offset"][lo])
            hi = max(lo + 1, int(np.searchsorted(ends, base + block, "right")))
            data = self._file.read_at(int(ends[hi - 1]) - base, base)
            for row, e in enumerate(self.index[lo:hi].tolist(), lo):
                yield None if row < self.nulls else e[0], self._ids(data[e[1] - base:e[1] - base + e[2]])
            lo = hi


def write_ids(
    docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, str]:
    """Encode whole texts, write the id files, and return their table
    ``(file, part, n_docs, n_tokens, start)`` and the dictionary's path.

    ``start`` is the number of ids in all files before. Documents go in
    ascending ``doc_id``, null ids first, repeated ids next to each other.
    Null texts count as empty: their ids are ``end_id`` alone. Other columns
    are ignored; an empty table writes no file. ``tokenizer_file`` is read
    once and stored in the shared folder for the tasks; its tokenizer must
    drop white space.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "ids"))
    with open(tokenizer_file, "rb") as f:
        tokenizer = write_bytes(f"{folder}/tokenizer.json", f.read())
    id_bytes = 2 if _encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4
    dtype = f"<u{id_bytes}"
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCS)
    pieces = sample.mapInArrow(_samples(tokenizer, end_id, dtype), "ids binary").orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_DOCS)
    samples = [bytes(r[0]) for r in pieces.collect()]
    raw = train_dictionary(samples) if samples else b""
    dictionary = write_bytes(f"{folder}/dictionary.zdict", raw)

    frames = materialize(docs.mapInArrow(
        _frames(tokenizer, dictionary, end_id, dtype), "doc_id long, n_tokens long, frame binary"), "id-frames")
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    files = materialize(
        frames.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "frame")
        .mapInArrow(_write_files(folder, hashlib.sha256(raw).digest(), id_bytes),
                    "file string, part long, n_docs long, n_tokens long"), "id-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), dictionary


def read_ids(files: DataFrame, dictionary: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""

    def run(batches):
        raw = read_bytes(dictionary)
        for batch in freeing(batches):
            for row in batch.to_pylist():
                start, out = row["start"], []
                for doc_id, ids in IdFile(row["file"], raw).documents():
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = max(1, files.count())
    return files.select("file", "start").repartition(parts, "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
