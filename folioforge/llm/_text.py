"""Words, hashes and shingles of whole Arrow string columns, by numpy.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``, with A-Z lower-cased.
All of these are ASCII, so UTF-8 bytes can be scanned without decoding. A range of
bytes is hashed from its length and its blocks of eight bytes, each scrambled into
the hash so far; ranges of over ``LONG`` bytes are hashed by xxHash.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 1 << 20
LONG = 256
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_ranges(data: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges ``first`` to ``last`` of ``data``."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:-8] = data
    block = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = last - first
    out = mix((block[first] & _FIRST[np.minimum(size, 8)]) ^ mix(size.astype(np.uint64) + np.uint64(seed << 32)))
    more = np.flatnonzero((size > 8) & (size <= LONG))
    at = 8
    while len(more):
        rest = size[more] - at
        out[more] = mix(out[more] * np.uint64(3) + (block[first[more] + at] & _FIRST[np.minimum(rest, 8)]))
        more, at = more[rest > 8], at + 8
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[first[k] : last[k]].tobytes(), seed)
    return out


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that is not used any more to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task that gives the memory it no longer uses back when it ends: workers live on for other stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = PIECE, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``most`` whole rows with about ``limit`` bytes of text each."""
    _, offsets = buffer_of(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, min(at + most, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        yield batch.slice(at, end - at)
        at = end


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, first byte and end byte (in the column's buffer) of every word, in order."""
    data, offsets = buffer_of(column)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    gap = SPACE[data]
    at, n = 0, len(data)
    edges = np.zeros(n + 1, bool)
    edges[offsets] = True
    while at < n:
        end = min(n, at + 4 * PIECE)
        while end < n and not (gap[end] or edges[end]):
            end += 1
        solid = ~gap[at:end]
        before = np.empty_like(solid)
        before[0], before[1:] = False, solid[:-1]
        first = np.flatnonzero(solid & (~before | edges[at:end]))
        after = np.empty_like(solid)
        after[-1], after[:-1] = False, solid[1:]
        last = np.flatnonzero(solid & (~after | edges[at + 1 : end + 1])) + 1
        out.append((hash_ranges(LOWER[data[at:end]], first, last), first + at, last + at))
        at = end
    if not out:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    hashes, first, last = (np.concatenate(x) for x in zip(*out, strict=True))
    return hashes, np.searchsorted(offsets, first, "right") - 1, first, last


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each run of ``k`` words within a row.

    A row with fewer words gives its whole sequence as one; a row without words none.
    """
    n = len(hashes)
    if not n:
        return hashes, rows, rows
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    counts = np.diff(np.r_[begins, n])
    short = np.flatnonzero(counts < k)
    full = np.flatnonzero(rows[: n - k + 1] == rows[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    value = np.zeros(len(full), np.uint64)
    for j in range(k):
        value = mix(value * np.uint64(3) + hashes[full + j])
    if not len(short):
        return value, rows[full], full
    few = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        here = counts[short] > j
        few[here] = mix(few[here] * np.uint64(3) + hashes[begins[short[here]] + j])
    few = mix(few + counts[short].astype(np.uint64))
    value, row, at = np.r_[value, few], np.r_[rows[full], rows[begins[short]]], np.r_[full, begins[short]]
    order = np.argsort(at, kind="stable")
    return value[order], row[order], at[order]


def distinct(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values once, sorted within the row."""
    if not len(value):
        return value, row
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1])]
    return value[new], row[new]

