"""Operator 2's features counted word by word, and its query's grades and tails computed from them."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm import quality
from folioforge.llm._text import words
from folioforge.session import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def shape_of(byte):
    if 65 <= byte <= 90:
        return ord("A")
    if 48 <= byte <= 57:
        return ord("0")
    return ord("a") if 97 <= byte <= 122 or byte >= 128 else byte


def unit(counts, dims):
    out = np.zeros(dims)
    for k, n in counts.items():
        out[k] = math.log1p(n)
    norm = math.sqrt((out * out).sum())
    return out / norm if norm else out


def plain_features(text):
    """Words by regular expression, everything else byte by byte; only a word's bucket comes from its hash."""
    data = (text or "").encode()
    found = re.findall(rb"[^\x20\x09-\x0d]+", data)
    bucket = lambda w: int(words(pa.array([w.decode(errors="replace")]))[0][0] >> np.uint64(54))
    shapes = [shape_of(b) for b in data]
    three = Counter((a * 961 + b * 31 + c) % quality.SHAPE_DIMS for a, b, c in zip(shapes, shapes[1:], shapes[2:], strict=False))
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in found]
    size, n = max(len(data), 1), max(len(low), 1)
    dense = [
        sum(a == b for a, b in zip(low, low[1:], strict=False)) / n,
        len(set(low)) / n,
        sum(65 <= b <= 90 for b in data) / size,
        sum(48 <= b <= 57 for b in data) / size,
        sum(32 < b < 127 and not chr(b).isalnum() for b in data) / size,
        data.count(b"\n") / size,
        sum(map(len, found)) / n / 10,
        math.log1p(len(found)) / 10,
    ]
    return np.r_[unit(Counter(map(bucket, low)), quality.WORD_DIMS), unit(three, quality.SHAPE_DIMS), dense]


def made(seed, n):
    chance = random.Random(seed)
    parts = ["the", "The", "THE", "été", "É", "42", "a1", "#!", "x\ny", "same same", "\t\n", "  ", "long" * 90]
    return [" ".join(chance.choices(parts, k=chance.randint(0, 40))) for _ in range(n)]


def test_features():
    texts = [None, "", " ", "a", "ab", "\n\n", *made(1, 80)]
    got = quality.features(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), quality.DIMS)
    assert np.allclose(got, [plain_features(t) for t in texts], atol=1e-5)
    assert quality.features(pa.array([], pa.string())).shape == (0, quality.DIMS)


def test_grades_and_tails_of_the_query(spark):
    texts = made(2, 120)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    out = {r.doc_id: r for r in quality.grade(docs, labels, wanted=2).collect()}
    for i, text in enumerate(texts):
        score = float(plain_features(text) @ model.weights)
        tails = [1 / (1 + math.exp(-(score - t))) for t in model.thresholds]
        assert out[i].expected_grade == pytest.approx(sum(tails), abs=1e-4)
        assert out[i].p_tail == pytest.approx(tails[1], abs=1e-4)
        assert out[i].selected == (out[i].p_tail >= 0.5)


def test_fit_lowers_the_loss_and_orders_thresholds():
    chance = np.random.default_rng(3)
    x = chance.normal(size=(900, 5))
    score = x @ np.array([2.0, -1.0, 0.5, 0, 0])
    grade = np.digitize(score + chance.logistic(size=900), [-1.5, 0.5, 2.0])
    model = quality.fit(x, grade)
    above = np.c_[np.ones(900), model.tails(x), np.zeros(900)]
    chosen = above[np.arange(900), grade] - above[np.arange(900), grade + 1]
    shares = defaultdict(float, {g: (grade == g).mean() for g in range(4)})
    assert -np.log(chosen).mean() < -np.log([shares[g] for g in grade]).mean() - 0.2
    assert (np.diff(model.thresholds) > 0).all()
