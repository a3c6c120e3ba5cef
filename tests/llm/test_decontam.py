"""Benchmark decontamination against all windows, and on odd tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm import decontam
from folioforge.llm._text import shingles, words
from folioforge.session import ship

SCHEMA = "doc_id long, text string, item_id long, similarity double, first_word int, t string, i int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 0.5, 3, "t", 4) for i, t in rows], SCHEMA)


def prose(chance, n):
    return ["".join(chance.choices("abcdefg", k=chance.randint(1, 4))) for _ in range(n)]


def grams(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return (a & b).total() / (a | b).total() if a and b else 0.0


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def brute(docs, items):
    """Similarity and first word of the best window for each document and item that match."""
    out = {}
    for d, text in docs:
        w = plain_words(text)
        for i, item in items:
            v = plain_words(item)
            if not v or not w:
                continue
            target = grams(v)
            starts = range(max(1, len(w) - len(v) + 1))
            best = max(((similarity(grams(w[s : s + len(v)]), target), -s) for s in starts), default=(0, 0))
            if best[0] >= 0.8:
                out[d, i] = (round(best[0], 9), -best[1])
    return out


def planted(seed):
    chance = random.Random(seed)
    items = [(i, " ".join(prose(chance, n))) for i, n in enumerate([3, 5, 7, 12, 20, 20, 33, 60, 60, 61])]
    items += [(20, items[7][1]), (21, "x y " * 15), (22, None), (23, " \n")]
    docs = []
    for d in range(130):
        own = prose(chance, chance.randint(0, 60))
        for _ in range(chance.randint(0, 2)):
            piece = items[chance.randrange(11)][1].split()
            for _ in range(chance.randint(0, 3)):
                piece[chance.randrange(len(piece))] = "new"
            if chance.random() < 0.3:
                del piece[chance.randrange(len(piece))]
            own += piece + prose(chance, chance.randint(0, 30))
        docs.append((d, chance.choice([" ", "\n", " \t"]).join(own).title()))
    return [*docs, (1000, None), (1001, ""), (1002, "x Y " * 400), (1003, " ".join(items[7][1].split()[4:]))], items


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_windows(spark, seed):
    docs, items = planted(seed)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    expected = brute(docs, items)
    rows = decontam.matches(docs_of(spark, docs), benchmark).collect()
    found = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word) for r in rows}
    assert len(rows) == len(found) and found.keys() <= expected.keys()
    assert len(found) >= 0.99 * len(expected) > 30
    assert all(found[x] == expected[x] for x in found)
    several = decontam.matches(docs_of(spark, docs), benchmark, pass_bytes=200).collect()
    assert sorted(map(tuple, several)) == sorted(map(tuple, rows))
    left = decontam.drop_contaminated(docs_of(spark, docs), benchmark, pass_bytes=500)
    assert left.columns == docs_of(spark, docs).columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in found}


def test_index_meets_every_fingerprint_within_the_radius():
    chance = np.random.default_rng(1)
    items = chance.integers(0, 1 << 63, 300, dtype=np.uint64)
    windows = items[chance.integers(0, 300, 2000)].copy()
    for bit in range(20):
        flip = chance.random(2000) < 0.8
        windows[flip] ^= np.uint64(1) << chance.integers(0, 64, flip.sum()).astype(np.uint64)
    w, i = decontam.Index(items, 20).near(windows)
    near = np.bitwise_count(windows[:, None] ^ items[None, :]) <= 20
    assert near.sum() > 1000 and sorted(zip(w.tolist(), i.tolist(), strict=True)) == list(map(tuple, np.argwhere(near).tolist()))


def test_odd_tables(spark):
    docs = docs_of(spark, [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (2, None), (3, "")])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(docs, empty).collect() == [] and decontam.drop_contaminated(docs, empty).count() == 5
    items = spark.createDataFrame([(1, "One two three four five six"), (1, "One two three four five six"), (None, "one two three four five six"), (5, "two three")], "item_id long, text string")
    out = [(r.doc_id, r.item_id, r.first_word) for r in decontam.matches(docs, items).collect()]
    assert sorted(out, key=str) == sorted([(d, i, f) for d in (1, 1, None) for i, f in ((1, 0), (1, 0), (None, 0), (5, 1))], key=str)
    assert {r.doc_id for r in decontam.drop_contaminated(docs, items).collect()} == {2, 3}
    assert decontam.matches(docs.where("false"), items).collect() == [] and decontam.drop_contaminated(docs.where("false"), items).collect() == []


def test_shingles_tell_alternating_words_apart():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    hashes, rows, _, _ = words(pa.array([a, b, a[:8], b[:8], "a", "a\0", "é" * 200, "é" * 201]))
    assert len(set(hashes.tolist())) == len(rows) == 8
    assert len(set(shingles(hashes, rows, 2)[0].tolist())) == 8
