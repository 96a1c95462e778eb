"""Vectorised helpers over Arrow text columns, used inside tasks.

A *word* is a maximal run of bytes other than space and the control bytes 9
to 13 (``[^\\x20\\x09-\\x0D]+``). NULL text counts as empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at once by the numpy code: the temporaries are about 60
# bytes per text byte, so one slice needs some 120 MB unless one document is longer.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words."""
    x = x.astype(_U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(1 << 32)) * _U(0x9E3779B97F4A7C15))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds at most ``max_bytes`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; NULL is empty."""
    arr = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0]:offsets[-1]], offsets - offsets[0]


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the word offsets of the documents (n + 1)."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    word = ~space
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_FIRST_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], _U)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    if not len(starts):
        return np.zeros(0, _U)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))     # the eight bytes from each place on
    left = ends - starts
    h = mix64((eight[starts] & _FIRST_BYTES[np.minimum(left, 8)]) ^ (left.astype(_U) * _U(0x9E3779B97F4A7C15)))
    rest = np.flatnonzero(left > 8)
    at, left = starts[rest] + 8, left[rest] - 8
    while len(rest):
        with np.errstate(over="ignore"):
            h[rest] = mix64((h[rest] * _U(0xD6E8FEB86659FD93)) ^ (eight[at] & _FIRST_BYTES[np.minimum(left, 8)]))
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    return h


def sorted_in_groups(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order by (group, value), ties in any order; ``group`` counts from 0."""
    order = np.argsort(values)
    small = group.astype(np.uint16) if len(group) and group.max() < 1 << 16 else group
    return order[np.argsort(small[order], kind="stable")]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (positions 0 .. n-k)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    salt = seeded(k, 11) | _U(1)
    with np.errstate(over="ignore"):
        h = words[:n] * salt[0]
        for j in range(1, k):
            h += words[j:j + n] * salt[j]
    return mix64(h)


def signed(x: np.ndarray) -> pa.Array:
    """64-bit words as a long column."""
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64), pa.int64())
