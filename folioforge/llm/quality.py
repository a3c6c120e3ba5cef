"""Operator 2: document quality by ordinal cumulative-link regression.

A text becomes hashed counts of its words and of its three-byte shapes (letters
``a`` or ``A``, digits ``0``, other bytes themselves), each scaled to unit length,
and eight proportions. One weight vector serves all grades: with ordered thresholds
t1 < t2 < ..., P(grade > k) = sigmoid(score - tk). The expected grade is the sum of
these, and a document is selected if its tail probability P(grade >= wanted) is at
least one half.

Fitting uses at most ``max_rows`` labelled documents of at most ``max_chars`` characters
outside fold 0 (``_labels``);
scoring reads every whole text. Defined results: null and empty texts have only the
constant; without any labels, or with one grade only, everything has that grade
(1.0 without labels) and is selected; rows that share an id are scored each; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm._labels import fold, sample
from folioforge.llm._text import buffer_of, lean, slices, words

WORD_DIMS = SHAPE_DIMS = 1024
DENSE = 8
DIMS = WORD_DIMS + SHAPE_DIMS + DENSE
_SHAPE = np.arange(256, dtype=np.int64)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def _unit(counts: np.ndarray) -> np.ndarray:
    counts = np.log1p(counts)
    norm = np.sqrt((counts * counts).sum(1, keepdims=True))
    return counts / np.where(norm > 0, norm, 1)


def features(column: pa.Array) -> np.ndarray:
    n = len(column)
    data, offsets = buffer_of(column)
    hashes, rows, first, last = words(column)
    out = np.zeros((n, DIMS), np.float32)
    if not n:
        return out
    bucket = (hashes >> np.uint64(54)).astype(np.int64)
    out[:, :WORD_DIMS] = _unit(np.bincount(rows * WORD_DIMS + bucket, minlength=n * WORD_DIMS).reshape(n, -1))
    row = np.repeat(np.arange(n), np.diff(offsets))
    shape = _SHAPE[data]
    if len(data) > 2:
        three = (shape[:-2] * 961 + shape[1:-1] * 31 + shape[2:]) % SHAPE_DIMS
        whole = row[:-2] == row[2:]
        out[:, WORD_DIMS : WORD_DIMS + SHAPE_DIMS] = _unit(np.bincount(row[:-2][whole] * SHAPE_DIMS + three[whole], minlength=n * SHAPE_DIMS).reshape(n, -1))
    size, count = np.maximum(np.diff(offsets), 1), np.bincount(rows, minlength=n)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])) + 1
    order = np.lexsort((hashes, rows))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])] if len(order) else np.zeros(0, bool)
    dense = out[:, WORD_DIMS + SHAPE_DIMS :]
    at_least = np.maximum(count, 1)
    dense[:, 0] = np.bincount(rows[again], minlength=n) / at_least
    dense[:, 1] = np.bincount(rows[order][new], minlength=n) / at_least
    for k, kind in ((2, shape == 65), (3, shape == 48), (4, (shape > 32) & (shape < 127) & (shape != 97) & (shape != 65) & (shape != 48)), (5, data == 10)):
        dense[:, k] = np.bincount(row[kind], minlength=n) / size
    dense[:, 6] = np.bincount(rows, weights=(last - first).astype(float), minlength=n) / at_least / 10
    dense[:, 7] = np.log1p(count) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return _sigmoid((x @ self.weights)[:, None] - self.thresholds[None, :])


def fit(x: np.ndarray, grade: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-5) -> Model:
    """Adam on the mean log likelihood; gaps between thresholds are exponentials, so their order holds."""
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return Model(grades or [1], np.zeros(DIMS), np.zeros(0))
    level = np.searchsorted(grades, grade)
    k = len(grades) - 1
    share = np.array([(level > j).mean() for j in range(k)])
    start = -np.log(share / (1 - share))
    free = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    p = np.r_[np.zeros(x.shape[1]), free]
    m, v = np.zeros_like(p), np.zeros_like(p)
    x = x.astype(np.float32)
    for step in range(1, steps + 1):
        w, free = p[: x.shape[1]], p[x.shape[1] :]
        gaps = np.exp(free[1:])
        thresholds = np.r_[free[0], free[0] + np.cumsum(gaps)]
        score = x @ w.astype(np.float32)
        above = np.c_[np.ones(len(x)), _sigmoid(score[:, None] - thresholds), np.zeros(len(x))]
        at = np.arange(len(x))
        upper, lower = above[at, level], above[at, level + 1]
        likelihood = np.maximum(upper - lower, 1e-9)
        slope = upper * (1 - upper), lower * (1 - lower)
        d_score = (slope[0] - slope[1]) / likelihood
        d_thresholds = np.zeros(k)
        np.add.at(d_thresholds, level[level > 0] - 1, -(slope[0] / likelihood)[level > 0])
        np.add.at(d_thresholds, level[level < k], (slope[1] / likelihood)[level < k])
        d_free = np.r_[d_thresholds.sum(), [d_thresholds[j + 1 :].sum() * gaps[j] for j in range(k - 1)]]
        g = -np.r_[x.T @ d_score.astype(np.float32), d_free] / len(x)
        g[: x.shape[1]] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    free = p[x.shape[1] :]
    return Model(grades, p[: x.shape[1]], np.r_[free[0], free[0] + np.cumsum(np.exp(free[1:]))])


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", most=1024):
            x = features(piece.column(piece.schema.get_field_index("text"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([piece.column(piece.schema.get_field_index("_id")), piece.column(piece.schema.get_field_index("label")), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_chars: int = 1 << 16, target: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = sample(docs, labels, target, max_rows, max_chars, id_col, text_col).mapInArrow(lean(_embed), f"id {docs.schema[id_col].dataType.simpleString()}, label int, x binary").toPandas().sort_values("id")
    x = np.frombuffer(b"".join(rows.x), np.float16).reshape(-1, DIMS)
    return fit(x, rows.label.to_numpy())


def _score(model: Model, wanted: int):
    place = next((k for k, g in enumerate(model.grades) if g >= wanted), len(model.grades))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_quality_text", most=1024):
                index = piece.schema.get_field_index("_quality_text")
                tails = model.tails(features(piece.column(index)))
                grade = model.grades[0] + tails @ np.diff(model.grades) if len(model.grades) > 1 else np.full(len(tails), float(model.grades[0]))
                p = np.ones(len(tails)) if place == 0 or len(model.grades) < 2 else tails[:, place - 1] if place <= tails.shape[1] else np.zeros(len(tails))
                rest = [c for k, c in enumerate(piece.columns) if k != index]
                names = [c for k, c in enumerate(piece.schema.names) if k != index]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(grade), pa.array(p)], names=[*names, "_quality_grade", "_quality_p"])

    return run


def score(docs: DataFrame, model: Model, wanted: int = 1, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) with ``_quality_grade`` and ``_quality_p``."""
    keep = docs.columns if keep is None else keep
    fields = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "_quality_grade double, _quality_p double"])
    return docs.select(*keep, F.col(text_col).alias("_quality_text")).mapInArrow(lean(_score(model, wanted)), fields)


def grade(docs: DataFrame, labels: DataFrame, wanted: int = 1, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row a document: its id, ``held_out``, ``expected_grade``, ``p_tail`` and ``selected``."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **settings)
    rows = score(docs, model, wanted, [id_col], text_col)
    return rows.select(id_col, (fold(id_col) == 0).alias("held_out"), F.col("_quality_grade").alias("expected_grade"), F.col("_quality_p").alias("p_tail"), (F.col("_quality_p") >= 0.5).alias("selected"))


def select(docs: DataFrame, labels: DataFrame, wanted: int = 1, **settings) -> DataFrame:
    """The documents that are selected, with all columns."""
    model = train(docs, labels, **settings)
    return score(docs, model, wanted, text_col=settings.get("text_col", "text")).where("_quality_p >= 0.5").select(*docs.columns)
