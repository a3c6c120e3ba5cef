"""Operator 5: toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text, and
every window of ``width`` words is compressed with each: a window that the toxic
dictionary shortens by more bytes is closer to toxic text. The dictionaries share a
part trained on ordinary windows, and a part trained on the ordinary windows that a
first toxic dictionary shortened wrongly, so they differ only where toxic text
does; the toxic one adds a part trained on what recurs in toxic documents and is at
least ten times rarer in ordinary ones. Shares of windows over thresholds of 1, 2,
3 and 5 bytes, the mean, the greatest and the three greatest differences are
calibrated by logistic regression on documents that trained no dictionary (one fold
of four), with the prior of all labels outside fold 0.

Fitting uses at most ``max_toxic`` and ``max_ordinary`` labelled documents of at most
``max_chars`` characters outside fold 0 (``_labels``), and the windows that ``fit`` bounds;
every whole text is scored. Defined results: null and empty
texts have no windows and get the score of no evidence; without both labels every
score is the prior (0.0 without labels); rows that share an id are scored each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm._labels import fold, sample

STEPS = (1, 2, 3, 5)
_BLANK = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def windows(text: str | None, width: int) -> list[bytes]:
    words = (text or "").encode().lower().translate(_BLANK).split(b" ")
    words = [w for w in words if w]
    return [b" " + b" ".join(words[i : i + width]) + b" " for i in range(0, len(words), width)]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Frames without headers, so lengths differ by content alone."""
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        window_log=15, hash_log=14, chain_log=14, search_log=6, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2,
    )
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


def train_content(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """The content of a trained dictionary; too few samples are their own dictionary."""
    if sum(map(len, samples)) <= 2 * size or len(samples) < 16:
        return b"".join(samples)[-size:]
    try:
        return zstandard.train_dictionary(size + 4000, samples, k=k, d=d).as_bytes()[-size:]
    except zstandard.ZstdError:  # too little that repeats
        return b"".join(samples)[-size:]


def _differences(parts: list[bytes], toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> np.ndarray:
    t, o = toxic.compress, ordinary.compress
    return np.array([len(o(w)) - len(t(w)) for w in parts], np.int64)


def _features(x: np.ndarray) -> list[float]:
    if not len(x):
        return [0.0] * (len(STEPS) + 3)
    return [x.mean(), *((x >= s).mean() for s in STEPS), min(x.max(), 8) / 8, np.sort(x)[-3:].sum() / 20]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * ridge, x.T @ (p - y) + ridge * w)
    return w


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0
    width: int = 4

    def scorer(self):
        if self.weights is None:
            return lambda text: self.prior
        toxic, ordinary = compressor(self.toxic), compressor(self.ordinary)

        def score(text: str | None) -> float:
            x = (np.array(_features(_differences(windows(text, self.width), toxic, ordinary))) - self.centre) / self.spread
            return float(1 / (1 + np.exp(-np.clip(np.r_[x, 1.0] @ self.weights, -30, 30))))

        return score


def _distinct_words(documents: list[list[bytes]]) -> list[set[bytes]]:
    return [set(b" ".join(d).split()) for d in documents]


def fit(rows: list[tuple[str, int, int]], prior: float, width: int = 4, size: int = 768, shared: int = 4096, windows_trained: int = 40_000, windows_searched: int = 200_000, windows_wrong: int = 20_000, least_share: float = 0.01, rarer: float = 10.0) -> Model:
    """``rows``: text, label and fold; fold 4 calibrates, the others train the dictionaries.

    The toxic part learns the words in at least ``least_share`` of toxic documents (and 3)
    that are ``rarer`` times rarer in ordinary ones. Each dictionary is trained on at most
    ``windows_trained`` windows; at most ``windows_searched`` ordinary ones are searched for
    wrongly shortened ones, of which ``windows_wrong`` train the shared part's rest.
    """
    chance = random.Random(5)
    first = {t: y for t, y, f in rows if f != 4}
    by_label = {y: [windows(t, width) for t, z in first.items() if z == y] for y in (0, 1)}
    calibrate = [(t, y) for t, y, f in rows if f == 4]
    if not by_label[0] or not by_label[1] or len({y for _, y in calibrate}) < 2:
        return Model(prior=prior, width=width)
    seen = {y: Counter(w for d in _distinct_words(by_label[y]) for w in d) for y in (0, 1)}
    n = {y: len(by_label[y]) for y in (0, 1)}
    marked = {w for w, c in seen[1].items() if c >= max(3, least_share * n[1]) and rarer * seen[0][w] / n[0] < c / n[1]}
    kept = []
    for d in by_label[1]:
        words = [w for w in b" ".join(d).split() if w in marked]
        kept += [b" " + b" ".join(words[i : i + 6]) + b" " for i in range(0, len(words), 6)]
    plain = [w for d in by_label[0] for w in d]
    for part in (kept, plain):
        chance.shuffle(part)
    base, own = train_content(plain[:windows_trained], shared, 16, 6), train_content(kept[:windows_trained], size, 12, 6)
    wrong = plain[:windows_searched]
    differ = _differences(wrong, compressor(own + base), compressor(base))
    wrong = [w for w, x in zip(wrong, differ, strict=True) if abs(x) >= 2]
    base = train_content(wrong[:windows_wrong], shared // 2, 16, 6) + base
    model = Model(own + base, base, prior=prior, width=width)
    toxic, ordinary = compressor(model.toxic), compressor(model.ordinary)
    x = np.array([_features(_differences(windows(t, width), toxic, ordinary)) for t, _ in calibrate])
    y = np.array([y for _, y in calibrate], float)
    model.centre, model.spread = x.mean(0), x.std(0) + 1e-9
    model.weights = _logistic(np.c_[(x - model.centre) / model.spread, np.ones(len(x))], y)
    here = min(max(y.mean(), 1e-3), 1 - 1e-3)
    wide = min(max(prior, 1e-3), 1 - 1e-3)
    model.weights[-1] += np.log(wide / (1 - wide)) - np.log(here / (1 - here))
    return model


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 1500, max_ordinary: int = 3000, max_chars: int = 1 << 16, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text", **bounds) -> Model:
    rows = sample(docs, labels, target, {1: max_toxic, 0: max_ordinary}, max_chars, id_col, text_col).select("_id", "text", "label", "fold").toPandas().sort_values("_id")
    known = labels.where(F.col(target).isNotNull() & (fold(id_col) != 0)).agg(F.avg(F.col(target).cast("double"))).first()[0]
    return fit(list(zip(rows.text, rows.label, rows.fold, strict=True)), float(known or 0.0), **bounds)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(score, batch.column(1).to_pylist())), pa.float64())], names=["id", "score"])

    return run


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row a document: its id, ``held_out``, ``score`` and ``predicted``."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **settings)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_score(model), f"id {docs.schema[id_col].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), (fold("id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
