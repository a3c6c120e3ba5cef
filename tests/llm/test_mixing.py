"""Operator 7 on rows without ids, with one id, copies and clashing columns, against prefix sums in Python."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from folioforge.llm import mixing

SCHEMA = "doc_id long, text string, source string, weight double, part int, size int, total long"


def key(i, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return hashlib.md5(f"{'' if i is None else i}:{inner}".encode()).hexdigest()


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("buckets", [None, 1, 977])
def test_odd_ids_and_copies(spark, buckets):
    chance = random.Random(6)
    rows = [(chance.choice([None, 5, k]), " ".join(chance.choices(["a", "bb", "Éc", "\x0bd"], k=chance.choice([0, 1, 7, 30]))), chance.choice(["hot"] * 5 + ["b", "", None])) for k in range(600)]
    rows += [(7, "the same text", "hot")] * 20 + [(8, None, "b"), (None, None, None)]
    out = mixing.plan(spark.createDataFrame([(*r, 1.0, 2, 3, 4) for r in rows], SCHEMA), buckets=buckets)
    assert out.columns == [f.split()[0] for f in SCHEMA.split(", ")] + ["_mix_size", "_mix_total", "_mix_target", "_mix_taken"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.source].append((key(r.doc_id, r.text), r._mix_size, r._mix_total, r._mix_target, r._mix_taken))
    for source in {r[2] for r in rows}:
        own = sorted((key(i, t), size(t)) for i, t, s in rows if s == source)
        total, expected, before = sum(n for _, n in own), [], 0
        target = got[source][0][3]
        whole = math.floor(target / total)
        for k, n in own:
            expected.append((k, n, total, target, whole * n + max(0, min(n, math.floor(target) - whole * total - before))))
            before += n
        assert sorted(got[source]) == sorted(expected)
        assert abs(sum(e[4] for e in expected) - target) <= 1


def test_one_id_spreads_over_buckets():
    """The keys of documents without ids, or with one id, differ with their texts."""
    assert len({key(None, f"text {k}")[:4] for k in range(2000)}) > 1900
