"""Helpers for Arrow stages over texts: bounded slices, vectorised words, and packed lists of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes of text that a Python stage holds at once.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``limit`` bytes of text; a longer text is a slice by itself."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column with empty strings for nulls."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def _compact(text: pa.Array, lower: bool) -> pa.Array:
    """The texts in buffers of their own, which begin at 0: kernels for ASCII go wrong on slices. A-Z are lowered if asked for."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    if lower:
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    return pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(np.ascontiguousarray(data)))


def coded(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the codes of all words in order, and the words of each text. Words are runs without ASCII white
    space; A-Z are lowered."""
    lists = pc.ascii_split_whitespace(_compact(text.cast(pa.large_string()), lower))
    counts, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    blank = pc.equal(pc.binary_length(flat), 0)  # before and after white space at the ends
    if pc.any(blank).as_py():
        at = np.repeat(np.arange(len(counts)), counts)
        counts = counts - np.bincount(at[blank.to_numpy(zero_copy_only=False)], minlength=len(counts))
        flat = flat.filter(pc.invert(blank))
    found = flat.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def words(text: pa.Array, lower: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """As ``coded``, with the distinct words in UTF-8."""
    dictionary, codes, counts = coded(text, lower)
    return dictionary.cast(pa.large_binary()).to_pylist(), codes, counts


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def word_hashes(dictionary: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word, the same on every machine."""
    from pandas.util import hash_array

    if not dictionary:
        return np.zeros(0, np.uint64)
    return mix(hash_array(np.array(dictionary, dtype=object), categorize=False))


def extend(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the sequence ``left`` followed by the word ``right``."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(0x632BE59BD9B4E019))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 values as differences, byte planes and zstd."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Counts or numbers in any order, mostly small, as byte planes and zstd."""
    if not len(values):
        return b""
    return zstandard.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_small(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()
