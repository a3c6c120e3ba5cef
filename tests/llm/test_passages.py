"""Repeated passages found by length, with the default bound and a lower one; cuts against their definition."""

import random

import numpy as np
import pytest

from folioforge.llm import chunks
from folioforge.llm._text import buffer_of
from folioforge.session import ship

SCHEMA = "doc_id long, text string"
#: Share of passages of so many words that are reported, at least: by ``min_words``.
RECALL = {22: {12: 0.0, 20: 0.0, 32: 0.0, 50: 0.97, 100: 1.0}, 12: {12: 0.0, 20: 0.1, 32: 0.88, 50: 1.0, 100: 1.0}, 6: {12: 0.0, 20: 0.7, 32: 1.0, 50: 1.0, 100: 1.0}}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def prose(chance, n):
    return " ".join("".join(chance.choices("abcdefghijklmnoprstu", k=chance.randint(2, 9))) for _ in range(n))


def planted(length, pairs=60):
    """Pairs of documents that share one passage, at shifted places."""
    chance, rows = random.Random(length), []
    for k in range(pairs):
        passage = prose(chance, length)
        for side in range(2):
            before, after = prose(chance, chance.randint(5, 60)), prose(chance, chance.randint(5, 60))
            rows.append((2 * k + side, f"{before} {passage} {after}", len(before.encode()) + 1, len(before.encode()) + 1 + len(passage.encode())))
    return rows


@pytest.mark.parametrize("length", [12, 20, 32, 50, 100])
def test_recall_by_length(spark, length):
    rows = planted(length)
    docs = spark.createDataFrame([r[:2] for r in rows], SCHEMA)
    place = {i: (a, b) for i, _, a, b in rows}
    for bound, expected in RECALL.items():
        found = chunks.repeats(docs, min_words=bound).collect()
        assert all(r.start >= place[r.doc_id][0] - 40 and r.end <= place[r.doc_id][1] + 40 and r.keeper_id == r.doc_id - 1 for r in found)
        share = len({r.doc_id for r in found}) / (len(rows) / 2)
        print(f"recall of {length} words at min_words {bound}: {share:.2f}")
        assert share >= expected[length], (bound, share)


def test_cuts_are_where_the_rolling_hash_is_greatest():
    """The definition, place by place: the hash of the last 32 bytes of a row, greatest within ``reach`` on both sides."""
    chance = random.Random(3)
    rows = [prose(chance, 60), "", "é" * 90, "a", prose(chance, 5) * 8]
    import pyarrow as pa

    data, offsets = buffer_of(pa.array(rows))
    for reach in (5, 20):
        expected = []
        for r, text in enumerate(rows):
            raw = text.encode()
            score = []
            for i in range(len(raw)):
                h = 0
                for b in raw[max(0, i - 31) : i + 1]:
                    h = (h << 1) + int(chunks.GEAR[b]) & 0xFFFFFFFF
                # A cut never parts the bytes of a character.
                score.append(0 if i + 1 < len(raw) and raw[i + 1] & 0xC0 == 0x80 else h)
            ends = [i + 1 for i, s in enumerate(score) if s > 0 and s >= max(score[i : i + reach + 1]) and s > max(score[max(0, i - reach) : i], default=0)]
            expected += [(r, e) for e in sorted({*ends, len(raw)} - {0})]
        row, first, end = chunks.cuts(data, offsets, reach, 1 << 20)
        assert [(int(r), int(e - offsets[r])) for r, e in zip(row, end, strict=True)] == expected
        assert np.array_equal(first[1:], end[:-1])
