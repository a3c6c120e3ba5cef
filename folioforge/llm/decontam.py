"""Operator 3: find benchmark passages in documents.

A benchmark item of ``L`` words is compared with windows of ``L`` words of every
document, and with the whole of a document that is shorter. A window's fingerprint is
the 64-bit SimHash of its five-word shingles; items' fingerprints lie in a
multi-index table of 8 blocks of 8 bits, where a window looks up every block value
within ``radius // 8`` bits, so by the pigeonhole principle it meets all items of its
size within ``radius``. Candidates are confirmed by exact weighted-shingle
similarity: the sum over shingles of the lesser count by that of the greater, 0.8 or
more.

Two sets of ``a`` and ``b`` shingles that reach the threshold ``p`` share at least
``p / (1 + p) * (a + b)`` of them, so a window with fewer shingles that any item
holds reaches none. Only the others, found by running sums, are fingerprinted.

Items are the stated query set: they are broadcast in passes of at most
``pass_bytes`` of text (a longer item is a pass of its own), whatever the number of
documents; each further pass reads the documents again.

Defined results: null and empty texts or items match nothing; an item of fewer than
five words is one shingle; equal items each match; rows that share an id each
match; an empty table on either side gives an empty result; other columns are not
read (``drop_contaminated`` passes them through). Where windows tie, the first counts.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm._text import lean, mix, shingles, slices, words

BLOCKS, BITS = 8, 8
#: Shingles whose votes are summed at once: 64 MB.
SPAN = 1 << 18


def _bits(value: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits."""
    return np.unpackbits(value.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * np.int8(2) - np.int8(1)


def fingerprints(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel()


class Index:
    """Fingerprints of the items of one size."""

    def __init__(self, prints: np.ndarray, radius: int) -> None:
        self.prints, self.radius = prints, radius
        near = np.array([m for n in range(min(BITS, radius // BLOCKS) + 1) for m in (sum(1 << b for b in c) for c in combinations(range(BITS), n))], np.uint8)
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        self.starts, self.items = [], []
        for k in range(BLOCKS):
            value = (blocks[:, k][:, None] ^ near[None, :]).ravel()
            order = np.argsort(value, kind="stable")
            self.items.append(np.repeat(np.arange(len(prints)), len(near))[order])
            self.starts.append(np.searchsorted(value[order], np.arange((1 << BITS) + 1)))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (window, item) within the radius, in order."""
        blocks = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BLOCKS)
        found = [np.zeros(0, np.int64)]
        for k in range(BLOCKS):
            start = self.starts[k][blocks[:, k]]
            count = self.starts[k][blocks[:, k].astype(np.int64) + 1] - start
            window = np.repeat(np.arange(len(prints)), count)
            item = self.items[k][np.arange(len(window)) + np.repeat(start - (np.cumsum(count) - count), count)]
            good = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
            found.append(window[good] * len(self.prints) + item[good])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


class Known:
    """A set of 64-bit values; most others are told by a table of bits alone."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        bits = max(12, int(len(self.values) * 16).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.values >> self.shift] = True

    def has(self, x: np.ndarray) -> np.ndarray:
        out = self.table[x >> self.shift]
        some = np.flatnonzero(out)
        if len(some):
            place = np.minimum(np.searchsorted(self.values, x[some]), len(self.values) - 1)
            out[some] = self.values[place] == x[some]
        return out


class Matcher:
    """Finds the items of one pass in the texts of a column."""

    def __init__(self, items: list[tuple[int, str]], k: int, percent: int, radius: int) -> None:
        self.k, self.percent = k, percent
        hashes, rows, _, _ = words(pa.array([t for _, t in items], pa.string()))
        value, row, _ = shingles(hashes, rows, k)
        self.ids = [i for i, _ in items]
        self.sizes = np.bincount(rows, minlength=len(items))
        self.counts = [Counter(value[a:b].tolist()) for a, b in zip(*self._ends(row, len(items)), strict=True)]
        self.known = Known(value)
        self.by_size: dict[int, tuple[np.ndarray, Index]] = {}
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        starts, ends = self._ends(row, len(items))
        for size in np.unique(self.sizes[self.sizes > 0]).tolist():
            which = np.flatnonzero(self.sizes == size)
            if size < k:
                for r in which.tolist():
                    self.short[size][int(value[starts[r]])].append(r)
            else:
                votes = np.stack([_bits(mix(value[starts[r] : ends[r]])).sum(0, dtype=np.int32) for r in which])
                self.by_size[size] = (which, Index(fingerprints(votes), radius))

    @staticmethod
    def _ends(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        ends = np.searchsorted(row, np.arange(n + 1))
        return ends[:-1], ends[1:]

    def least(self, total: int) -> int:
        """Shingles that two sets of ``total`` together share if they reach the threshold."""
        return -(-self.percent * total // (100 + self.percent))

    def search(self, column: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """The best window of each row and item that match: row, item id, similarity, first word, words."""
        hashes, rows, _, _ = words(column)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        starts, ends = self._ends(rows, len(column))
        for size, values in self.short.items():
            self._equal(hashes, rows, starts, size, values, best)
        if self.by_size:
            value, row, at = shingles(hashes, rows, self.k)
            known = self.known.has(value)
            has = np.bincount(row[known], minlength=len(column))
            least = self.least(2 * (min(self.by_size) - self.k + 1))
            count = np.maximum(ends - starts - self.k + 1, 1)
            for r in np.flatnonzero((ends - starts >= self.k) & (ends - starts < max(self.by_size)) & (100 * has * 2 >= self.percent * (2 * count + 1 - has))).tolist():
                self._whole(r, hashes[starts[r] : ends[r]], int(has[r]), best)
            some = (has >= least)[row]
            if some.any():
                self._windows(value[some], row[some], (at - starts[row])[some], known[some], best)
        return [(r, self.ids[i], similarity, first, int(min(self.sizes[i], ends[r] - starts[r]))) for (r, i), (similarity, first) in sorted(best.items())]

    def _equal(self, hashes: np.ndarray, rows: np.ndarray, starts: np.ndarray, size: int, values: dict[int, list[int]], best: dict) -> None:
        """Items of fewer than ``k`` words are one shingle, so a window is near one if it is equal."""
        n = len(hashes) - size + 1
        if n <= 0:
            return
        full = np.flatnonzero(rows[:n] == rows[size - 1 :])
        made = np.zeros(len(full), np.uint64)
        for j in range(size):
            made = mix(made * np.uint64(3) + hashes[full + j])
        made = mix(made + np.uint64(size))
        wanted = np.array(sorted(values), np.uint64)
        for w in np.flatnonzero(np.isin(made, wanted)).tolist():
            r = int(rows[full[w]])
            for i in values[int(made[w])]:
                best.setdefault((r, i), (1.0, int(full[w] - starts[r])))

    def _whole(self, r: int, hashes: np.ndarray, has: int, best: dict) -> None:
        """Compare a document with every longer item that it can still be near."""
        n = len(hashes) - self.k + 1
        longer = [s for s in self.by_size if s > len(hashes) and 100 * n >= self.percent * (s - self.k + 1) and has >= self.least(n + s - self.k + 1)]
        if not longer:
            return
        value, _, _ = shingles(hashes, np.zeros(len(hashes), np.int64), self.k)
        mine = Counter(value.tolist())
        fingerprint = fingerprints(_bits(mix(value)).sum(0, dtype=np.int32)[None, :])
        for size in longer:
            which, index = self.by_size[size]
            for i in index.near(fingerprint)[1].tolist():
                self._confirm(mine, r, int(which[i]), 0, best)

    def _confirm(self, mine: Counter, r: int, i: int, first: int, best: dict) -> None:
        item = self.counts[i]
        common = sum(min(n, item[s]) for s, n in mine.items() if s in item)
        whole = mine.total() + item.total() - common
        if 100 * common >= self.percent * whole and common / whole > best.get((r, i), (0.0, 0))[0]:
            best[r, i] = (common / whole, first)

    def _windows(self, value: np.ndarray, row: np.ndarray, first: np.ndarray, known: np.ndarray, best: dict) -> None:
        total = np.r_[0, np.cumsum(known)]
        for size, (which, index) in self.by_size.items():
            width = size - self.k + 1
            if len(value) < width:
                continue
            near = np.flatnonzero((total[width:] - total[:-width] >= self.least(2 * width)) & (row[: len(row) - width + 1] == row[width - 1 :]))
            while len(near):
                here = near[: np.searchsorted(near, near[0] + SPAN)]
                near = near[len(here) :]
                low, high = int(here[0]), int(here[-1]) + width
                votes = np.zeros((high - low + 1, 64), np.int32)
                np.cumsum(_bits(mix(value[low:high])), axis=0, dtype=np.int32, out=votes[1:])
                window, item = index.near(fingerprints(votes[here - low + width] - votes[here - low]))
                for w, i in zip(here[window].tolist(), which[item].tolist(), strict=True):
                    if best.get((int(row[w]), i), (0.0, 0))[0] < 1:
                        self._confirm(Counter(value[w : w + width].tolist()), int(row[w]), i, int(first[w]), best)


def _search(items: Broadcast, k: int, percent: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, k, percent, radius)
        for batch in batches:
            for piece in slices(batch, "text"):
                if out := matcher.search(piece.column(1)):
                    row, *rest = zip(*out, strict=True)
                    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(row)), *map(pa.array, rest, kinds)], names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

    return run


def _clean(items: Broadcast, k: int, percent: int, radius: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, k, percent, radius)
        for batch in batches:
            for piece in slices(batch, text):
                stay = np.ones(piece.num_rows, bool)
                stay[[m[0] for m in matcher.search(piece.column(piece.schema.get_field_index(text)))]] = False
                yield piece.filter(pa.array(stay))

    return run


def _passes(benchmark: DataFrame, pass_bytes: int, item_col: str, item_text: str) -> Iterator[Broadcast]:
    """The items with words, in broadcasts of bounded size."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where(F.col("t").rlike(r"[^\x20\x09-\x0D]"))
    context, held, size = benchmark.sparkSession.sparkContext, [], 0
    for row in items.toLocalIterator():
        if held and size + len(row.t) > pass_bytes:
            yield context.broadcast(held)
            held, size = [], 0
        held.append((row.i, row.t))
        size += len(row.t)
    if held:
        yield context.broadcast(held)


def matches(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80, radius: int = 20, pass_bytes: int = 1 << 24, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item found in it: ``similarity``, ``first_word`` and ``n_words``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in _passes(benchmark, pass_bytes, item_col, item_text):
        found = rows.mapInArrow(lean(_search(items, k, percent, radius)), "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = out.union(found) if out is not None else found
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long, n_words long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80, radius: int = 20, pass_bytes: int = 1 << 24, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no item is found, with all columns; rows are judged by their text alone, whatever their id."""
    for items in _passes(benchmark, pass_bytes, item_col, item_text):
        docs = docs.mapInArrow(lean(_clean(items, k, percent, radius, text_col)), docs.schema)
    return docs
