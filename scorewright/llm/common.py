"""What several operators share: words, hashes, worker caches, hand-over tables.

Texts reach Python as UTF-8 bytes. `bytes.split` without arguments cuts at exactly the six ASCII white
spaces (0x20, 0x09-0x0D) and `bytes.lower` changes exactly A-Z, which is what the word rules ask for.
"""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ..session import shared_folder

#: Bytes that a worker's memo holds before it starts anew, and the longest key that it keeps.
CACHE_BYTES = 64 << 20
LONGEST_KEY = 64
#: Bytes of text that an operator takes apart at once.
CHUNK_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_caches: dict[str, object] = {}
_owner: list[str] = []


def worker_cache(owner: str, name: str, make: Callable[[], object]) -> object:
    """A thing that is made once for each Python worker, for one operator at a time: Spark hands a worker
    from job to job, and what the operator before had kept goes when another one asks."""
    if _owner != [owner]:
        _caches.clear()
        _give_back()
        _owner[:] = [owner]
    if name not in _caches:
        _caches[name] = make()
    return _caches[name]


def _give_back() -> None:
    """What is free in this process goes back to the machine; the allocators would keep it for this worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


class Remembered(dict):
    """A memo bounded by bytes: computes a missing value. When half of the bytes are full, they become the
    older half, and what was the older half before is forgotten; values met again move to the younger one.
    Values of long keys (base64 and minified lines) are computed each time."""

    def __init__(self, function: Callable, limit: int = CACHE_BYTES):
        super().__init__()
        self.function, self.limit, self.held, self.older = function, limit, 0, {}

    def __missing__(self, key):
        if len(key) > LONGEST_KEY:
            return self.function(key)
        value = self.older.pop(key, None)
        if value is None:
            value = self.function(key)
        size = sys.getsizeof(key) + sys.getsizeof(value) + 100  # and the dictionary's own
        if 2 * (self.held + size) > self.limit:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self[key] = value
        return value


def chunks_of(batches: Iterator[pa.RecordBatch], column: str, at_most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many bytes of text, or of one row."""
    for batch in batches:
        texts = batch.column(column)
        if not batch.num_rows:
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + at_most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, one after another, and where each value starts and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return flat, (offsets - offsets[0]).astype(np.int64)


#: Classes of bytes for `pieces_of`.
OTHER, LETTER, MARK, GAP = 0, 1, 2, 4


def byte_classes(gaps: bytes, letters: bytes = b"", marks: bytes = b"") -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for kind, members in ((LETTER, letters), (MARK, marks), (GAP, gaps)):
        table[np.frombuffer(members, np.uint8)] = kind
    return table


def pieces_of(texts: pa.Array, classes: np.ndarray, change: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at gaps, and between letters and marks, without a Python object for each piece: the
    number of every piece's value, where each text's pieces start and the last ones end, and the distinct
    values. `change` is what each byte becomes before that."""
    flat, offsets = bytes_of(texts)
    if change is not None:
        flat = change[flat]
    kinds = classes[flat]
    before = np.empty_like(kinds)
    if len(kinds):
        before[0] = GAP
        before[1:] = kinds[:-1]
        starts = offsets[:-1]
        before[starts[starts < len(kinds)]] = GAP
    kept = kinds != GAP
    begins = (((kinds | before) == LETTER + MARK) | (before == GAP)) & kept
    at = np.flatnonzero(begins)
    ends = np.append(np.flatnonzero(begins[kept]), np.count_nonzero(kept)).astype(np.int32)
    values = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(flat[kept])])
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(at, offsets), coded.dictionary


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit hash depends on every other (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    memo = worker_cache("words", "words", lambda: Remembered(xxhash.xxh3_64_intdigest))
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


#: Classes in which words end at the six ASCII white spaces only.
SPACES = byte_classes(b" \t\n\x0b\x0c\r")


def text_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The word hashes of every text of a column, words as `bytes.split` cuts them; null has none."""
    codes, bounds, values = pieces_of(texts, SPACES)
    return np.split(word_hashes(values.to_pylist())[codes], bounds[1:-1]) if len(texts) else []


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of `size` consecutive word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * _BASE + hashes[k : k + n]
    return mixed(total)


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; fewer words are one shingle as a whole."""
    hashes = word_hashes(words)
    if not words:
        return hashes
    if len(words) < size:
        return window_hashes(hashes, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(hashes, size))


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(hashes, np.uint64).view(np.int64)


def rows_of(batches: Iterator[pa.RecordBatch], at_most: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that Python holds few texts at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, at_most):
            yield batch.slice(k, at_most)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One Arrow list for each part."""
    ends = np.cumsum([0] + [len(p) for p in parts], dtype=np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: later jobs do not compute them again,
    and a lost executor costs no more than its own tasks."""
    path = f"{shared_folder(df.sparkSession)}/scorewright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
