"""Operator 8: passages that repeat across documents, by content-defined chunks.

A gear hash rolls over the bytes (each step shifts the hash left and adds the new
byte's random value, so 32 bytes count). A chunk ends where the hash is the
greatest within ``reach`` bytes on either side: that depends on nothing further
away, so an insertion moves the cuts around it and no others. Chunks are at least
``reach`` bytes apart and split at ``longest`` bytes where no maximum comes. Equal
128-bit digests are equal chunks; the least ``doc_id`` that holds one keeps it, and
runs of other documents' copies of ``min_words`` words or more are repeats if one
document keeps at least half of their words (else they are a mosaic of unrelated
chunks, and stay). A passage loses the hash's window at its beginning and up to a chunk
of about 7 words at either end, so ``min_words`` counts what is left: the tests measure
the recall of passages by length, at the default and at lower bounds for shorter ones.
Digests meet in partial aggregates, so a
chunk in a third of all documents costs one row a task; what is shared is written, so
that Spark can split what meets a frequent chunk.

Defined results: null and empty texts have no chunks; repeats inside one document,
or in rows that share its id, are not repeats across documents; rows without an id
neither count nor lose text; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm._store import Scratch
from folioforge.llm._text import SPACE, buffer_of, hash_ranges, lean, slices

WINDOW = 32
_rng = np.random.Generator(np.random.PCG64(77))
GEAR = _rng.integers(0, 1 << 32, 256, dtype=np.uint32)


def _greatest(x: np.ndarray, n: int) -> np.ndarray:
    """out[i] = max(x[i : i + n]), by doubling."""
    out, have = x.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:-step] = np.maximum(out[:-step], out[step:])
        have += step
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, reach: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end byte of every chunk; rows never see each other's bytes."""
    sizes = np.diff(offsets)
    gap = WINDOW + reach
    spread = np.repeat(np.arange(len(sizes)) * gap, sizes) + np.arange(len(data)) + gap
    total = len(data) + (len(sizes) + 1) * gap
    roll = np.zeros(total, np.uint32)
    roll[spread] = GEAR[data]
    for s in range(5):
        more = roll[: -(1 << s)] << np.uint32(1 << s)
        roll[1 << s :] += more
    score = np.zeros(total, np.uint32)
    score[spread] = roll[spread]
    starts_char = (data & 0xC0) != 0x80
    inside = np.r_[~starts_char[1:], False] if len(data) else starts_char
    score[spread[inside]] = 0
    ahead = _greatest(score, reach + 1)
    left = np.zeros(total, np.uint32)
    left[reach:] = _greatest(score, reach)[: total - reach]
    here = (score[spread] > 0) & (score[spread] >= ahead[spread]) & (score[spread] > left[spread])
    ends = np.flatnonzero(here) + 1
    ends = np.union1d(ends, offsets[1:][sizes > 0])
    row = np.searchsorted(offsets, ends - 1, "right") - 1
    first = np.r_[0, ends[:-1]] if len(ends) else ends
    if len(ends) and (ends - first).max() > longest:
        pieces = []
        for r, a, b in zip(row.tolist(), first.tolist(), ends.tolist(), strict=True):
            while b - a > longest:
                c = a + longest
                while c > a + 1 and not starts_char[c]:
                    c -= 1
                pieces.append((r, a, c))
                a = c
            pieces.append((r, a, b))
        row, first, ends = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
    return row, first, ends


def _chunk(reach: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = buffer_of(piece.column(1))
                row, first, end = cuts(data, offsets, reach, longest)
                digests = [hash_ranges(data, first, end, seed).view(np.int64) for seed in (1, 2)]
                gap = SPACE[data]
                begins = ~gap & np.r_[True, gap[:-1]] if len(data) else gap
                count = np.r_[0, np.cumsum(begins)]
                order = np.arange(len(row)) - np.searchsorted(row, row, "left")
                ids = piece.column(0).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(order.astype(np.int32)), pa.array((first - offsets[row]).astype(np.int64)), pa.array((end - offsets[row]).astype(np.int64)), pa.array((count[end] - count[first]).astype(np.int32)), *map(pa.array, digests)],
                    names=["id", "k", "start", "end", "n_words", "a", "b"],
                )

    return run


def repeats(docs: DataFrame, reach: int = 20, longest: int = 2048, min_words: int = 22, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages to drop: ``doc_id``, ``keeper_id`` (the document that keeps most of it), byte ``start`` and ``end``, ``n_words``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chunks = rows.mapInArrow(lean(_chunk(reach, longest)), "id long, k int, start long, end long, n_words int, a long, b long")
    shared = chunks.groupBy("a", "b").agg(F.min("id").alias("keeper"), F.max("id").alias("other")).where("keeper <> other").select("a", "b", "keeper")
    shared = Scratch(docs.sparkSession, "chunks").keep(shared, "shared")
    copies = chunks.join(shared, ["a", "b"]).where("id <> keeper")
    copies = copies.groupBy("id", "k", "start", "end").agg(F.min("keeper").alias("keeper"), F.max("n_words").alias("n_words"))
    order = Window.partitionBy("id").orderBy("k")
    runs = copies.withColumn("island", F.col("k") - F.dense_rank().over(order))
    by_keeper = runs.groupBy("id", "island", "keeper").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"))
    most = F.max(F.struct(F.col("n_words"), -F.col("keeper")))
    whole = by_keeper.groupBy("id", "island").agg(most.alias("most"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"))
    found = whole.where((F.col("n_words") >= min_words) & (2 * F.col("most.n_words") >= F.col("n_words")))
    return found.select(F.col("id").alias("doc_id"), (-F.col("most.col2")).alias("keeper_id"), "start", "end", "n_words")


def _without(text: str, spans: list) -> str:
    data, at, out = text.encode(), 0, []
    for s in sorted(spans, key=lambda s: s["start"]):
        out.append(data[at : s["start"]])
        at = max(at, s["end"])
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, spans = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        new = [_without(t, s) if s and t else t for t, s in zip(text, spans, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()), *batch.columns[2:]], names=["_chunk_text", *batch.schema.names[2:]])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with repeated passages cut out of the text column."""
    found = repeats(docs, id_col=id_col, text_col=text_col, **settings).groupBy(F.col("doc_id").alias("_chunk_id")).agg(F.collect_list(F.struct("start", "end")).alias("_chunk_spans"))
    rows = docs.join(found, docs[id_col] == found["_chunk_id"], "left")
    rest = [c for c in docs.columns if c != text_col]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    out = rows.select(text_col, "_chunk_spans", *rest).mapInArrow(_rewrite, f"_chunk_text string{', ' if rest else ''}{fields}")
    return out.select(*[F.col("_chunk_text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
