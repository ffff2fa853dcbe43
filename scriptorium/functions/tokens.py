"""Tokenisation as columns.

Two families:

* code points: one id per Unicode code point, a tokenizer whose results
  DuckDB can reproduce, used by the oracle-checked queries. The batched form
  encodes a whole Arrow batch to UTF-32 with numpy; a pure JVM expression
  is kept for plans that must not leave the JVM;
* byte-level BPE through an iterator ``arrow_udf``: the tokenizer file is
  loaded once per Python worker and slices of Arrow batches go through
  ``encode_batch``. No special tokens are added, nothing is truncated.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDS = T.ArrayType(T.IntegerType())

# bytes of text, or ids, that a worker takes at a time from an Arrow batch
SLICE = 1 << 18
# what a row counts besides
ROW = 64


def _slices(batch: pa.Array, *more: pa.Array) -> Iterator:
    """``batch`` (and columns beside it) in slices of about ``SLICE``, one row
    at least: what is made of a batch is many times its size, so that a worker
    makes and hands over a slice at a time."""
    size = np.zeros(len(batch), np.int64)
    for column in (batch, *more):
        n = pc.list_value_length(column) if pa.types.is_nested(column.type) else pc.binary_length(column)
        size += n.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW
    upto, at = np.cumsum(size), 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
        part = [column.slice(at, end - at) for column in (batch, *more)]
        yield part if more else part[0]
        at = end


# -- code points ----------------------------------------------------------------

def codepoint_ids_expr(text: Column) -> Column:
    """One id per code point as a pure JVM expression (non-BMP is one id).

    Interpreted per character (a string per character), so it is the slower
    form; :func:`codepoint_ids` is the batched one.
    """
    return F.transform(F.filter(F.split(text, "", -1), lambda c: c != ""), lambda c: F.ascii(c))


@F.arrow_udf(IDS)
def _codepoints_arrow(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for s in _slices(batch):
            values = s.to_pylist()
            enc = [b"" if v is None else v.encode("utf-32-le") for v in values]
            offsets = np.zeros(len(enc) + 1, dtype=np.int32)
            np.cumsum([len(b) // 4 for b in enc], out=offsets[1:])
            ids = np.frombuffer(b"".join(enc), dtype=np.int32)
            mask = pa.array([v is None for v in values], type=pa.bool_())
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=mask)


def codepoint_ids(text: Column) -> Column:
    """One id per code point, encoded a slice of an Arrow batch at a time."""
    return _codepoints_arrow(text)


def codepoint_text_expr(ids: Column) -> Column:
    """Inverse of :func:`codepoint_ids` as a JVM expression, one id at a time
    (``char`` would wrap above U+00FF, so each id goes through UTF-32)."""
    return F.array_join(
        F.transform(ids, lambda x: F.decode(F.unhex(F.lpad(F.hex(x), 8, "0")), "UTF-32")), ""
    )


@F.arrow_udf(T.StringType())
def _codepoint_text_arrow(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for a in _slices(batch):
            offsets = a.offsets.to_numpy()
            held = a.values.slice(offsets[0], offsets[-1] - offsets[0])
            raw = held.to_numpy(zero_copy_only=False).astype("<u4", copy=False).tobytes()
            offsets = 4 * (offsets.astype(np.int64) - offsets[0])
            valid = a.is_valid().to_numpy(zero_copy_only=False)
            yield pa.array([raw[offsets[i]:offsets[i + 1]].decode("utf-32-le") if valid[i] else None
                            for i in range(len(a))], type=pa.string())


def codepoint_text(ids: Column) -> Column:
    """Inverse of :func:`codepoint_ids`, decoded a slice of an Arrow batch at a time."""
    return _codepoint_text_arrow(ids)


# -- byte-level BPE ----------------------------------------------------------------

def default_tokenizer_file() -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.json")
    except ImportError:  # pragma: no cover - gated optional package
        return os.environ.get("SCRIPTORIUM_TOKENIZER", "byte_bpe_50k.json")


@dataclass(frozen=True)
class TokenizerSpec:
    """A tokenizer as an artifact of a job: its special ids and the digest of
    its file, which was shipped to the workers under that name and is checked
    there before use. ``pad_id`` falls back to ``eos_id`` when the vocabulary
    has no pad token.
    """

    sha256: str
    eos_id: int | None = None
    pad_id: int | None = None

    @property
    def file_name(self) -> str:
        return f"tokenizer-{self.sha256}.json"

    @property
    def effective_pad_id(self) -> int | None:
        return self.pad_id if self.pad_id is not None else self.eos_id


# code points as a tokenizer without a file: a line feed ends a text, nothing pads
CODEPOINTS = TokenizerSpec(sha256="", eos_id=10)

_CACHE: dict[str, object] = {}
_SHIPPED: set[tuple[str, str]] = set()


def bpe_spec(path: str | None = None, eos_token: str = "<|endoftext|>", pad_token: str = "<pad>",
             spark: SparkSession | None = None) -> TokenizerSpec:
    """Read a tokenizer file on the driver and ship it with ``addFile``."""
    from tokenizers import Tokenizer

    with open(path or default_tokenizer_file(), "rb") as f:
        raw = f.read()
    tok = Tokenizer.from_str(raw.decode())
    spec = TokenizerSpec(hashlib.sha256(raw).hexdigest(), tok.token_to_id(eos_token), tok.token_to_id(pad_token))
    sc = (spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()).sparkContext
    if (sc.applicationId, spec.sha256) not in _SHIPPED:
        target = os.path.join(tempfile.mkdtemp(prefix="scriptorium-tokenizer-"), spec.file_name)
        with open(target, "wb") as f:
            f.write(raw)
        sc.addFile(target)
        _SHIPPED.add((sc.applicationId, spec.sha256))
    return spec


def _spec(tokenizer: str | TokenizerSpec | None) -> TokenizerSpec:
    return tokenizer if isinstance(tokenizer, TokenizerSpec) else bpe_spec(tokenizer)


def _load(spec: TokenizerSpec):
    """The shipped tokenizer, in a worker; a file with another digest raises."""
    tok = _CACHE.get(spec.sha256)
    if tok is None:
        from pyspark import SparkFiles
        from tokenizers import Tokenizer

        with open(SparkFiles.get(spec.file_name), "rb") as f:
            raw = f.read()
        if hashlib.sha256(raw).hexdigest() != spec.sha256:
            raise ValueError(f"{spec.file_name} is not the tokenizer that was shipped")
        tok = _CACHE[spec.sha256] = Tokenizer.from_str(raw.decode())
    return tok


def _encoded(tok, texts: pa.Array, mask: pa.Array | None = None) -> pa.ListArray:
    """The ids of ``texts``; a null text is encoded as an empty one."""
    found = tok.encode_batch(["" if v is None else v for v in texts.to_pylist()], add_special_tokens=False)
    ids = [np.asarray(e.ids, dtype=np.int32) for e in found]
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)), mask=mask)


def bpe_encoder(tokenizer: str | TokenizerSpec | None = None):
    """A column function ``text -> array<int>`` backed by ``encode_batch``."""
    spec = _spec(tokenizer)

    @F.arrow_udf(IDS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = _load(spec)
        for batch in batches:
            for s in _slices(batch):
                yield _encoded(tok, s, s.is_null())

    return encode


def bpe_pair_encoder(tokenizer: str | TokenizerSpec | None = None):
    """Encode two text columns in one Arrow pass: ``struct<a: ids, b: ids>``."""
    spec = _spec(tokenizer)
    schema = T.StructType([T.StructField("a", IDS), T.StructField("b", IDS)])

    @F.arrow_udf(schema)
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tok = _load(spec)
        for batch in batches:
            for a, b in _slices(*batch):
                yield pa.StructArray.from_arrays([_encoded(tok, a), _encoded(tok, b)], names=["a", "b"])

    return encode


def bpe_decoder(tokenizer: str | TokenizerSpec | None = None, skip_special_tokens: bool = True):
    """A column function ``array<int> -> text`` backed by ``decode_batch``."""
    spec = _spec(tokenizer)

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = _load(spec)
        for batch in batches:
            for s in _slices(batch):
                ids = [v or [] for v in s.to_pylist()]
                yield pa.array(tok.decode_batch(ids, skip_special_tokens=skip_special_tokens), type=pa.string())

    return decode
