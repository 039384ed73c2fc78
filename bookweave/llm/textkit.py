"""Whole-batch text primitives over Arrow buffers: word spans, 64-bit word hashes and word shingles.

Texts are taken as UTF-8 bytes. A null text is an empty one. Work goes in runs of
documents of about ``RUN_BYTES``, so memory follows the longest document, not the batch.
Hashes are 64 bits wide: two unequal words or shingles agree with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240501))
CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODE[SPACE] = 0
STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0..n-1 modulo 2**64, and their inverses."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, RUN_BYTES)
        up, down = np.full(size, BASE), np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; offsets has one entry more than the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), offsets


def runs(column: pa.Array | pa.ChunkedArray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of consecutive documents, limit bytes together or one longer document."""
    data, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    pa.default_memory_pool().release_unused()  # workers outlive their tasks and would keep it


def spans(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not space, and each document's first run; none crosses documents."""
    edge = np.zeros(len(space) + 1, bool)
    edge[offsets] = True
    word = ~space
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= space[:-1]
    after[:-1] |= space[1:]
    starts = np.flatnonzero(word & before)
    return starts, np.flatnonzero(word & after) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = CODE) -> np.ndarray:
    """64-bit hashes of data[start:end] with a code for each byte."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents, and each document's first word; fold lower-cases A-Z."""
    starts, ends, first = spans(SPACE[data], offsets)
    return hashes(FOLD[data] if fold else data, starts, ends), first


def shingles(word: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words in order, and each document's first one; a document of fewer words has one, of them all."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    out = np.empty(at[-1], np.uint64)
    if len(word) >= k:
        rolled = word[: len(word) - k + 1] * STEP[0]
        for i in range(1, k):
            rolled += word[i : len(word) - k + 1 + i] * STEP[i]
        full = np.repeat(n >= k, count)
        out[full] = mix(rolled[(np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1]))[full]])
    for d in np.flatnonzero((n > 0) & (n < k)):
        w = word[first[d] : first[d + 1]]
        out[at[d]] = mix((w * STEP[: len(w)]).sum(keepdims=True) + STEP[32 + len(w) : 33 + len(w)])[0]
    return out, at
