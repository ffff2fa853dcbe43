"""Files in the shared folder, written and read by tasks and by the driver."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs

from scriptorium.session import qualified

__all__ = ["Writer", "freeing", "qualified", "read_bytes", "sole", "write_bytes"]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def read_bytes(uri: str) -> bytes:
    store, path = _open(uri)
    with store.open_input_file(path) as f:
        return f.read()


class Writer:
    """A file that appears under its name only when it is complete, so that a
    second attempt of a task never leaves or reads half a file."""

    def __init__(self, uri: str):
        self.uri = uri
        self._store, self._path = _open(uri)
        self._store.create_dir(self._path.rsplit("/", 1)[0], recursive=True)
        self._temporary = f"{self._path}.{uuid.uuid4().hex}"
        self._out = self._store.open_output_stream(self._temporary)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> str:
        self._out.close()
        self._store.move(self._temporary, self._path)
        return self.uri


def write_bytes(uri: str, data: bytes) -> str:
    out = Writer(uri)
    out.write(data)
    return out.close()


_SOLE: dict[tuple, object] = {}


def sole(load: Callable, uri: str):
    """``load(uri)``, held in the worker until another large object is: a
    worker lives on through the stages of a job and keeps one of them."""
    key = load.__module__, load.__qualname__, uri
    if key not in _SOLE:
        _SOLE.clear()
        _SOLE[key] = load(uri)
    return _SOLE[key]


@functools.lru_cache(maxsize=1)
def _trim():
    """glibc's ``malloc_trim``; other C libraries have none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; what a batch has used goes back to the system before the
    next, as Python workers live on through many tasks."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        _trim()(0)
