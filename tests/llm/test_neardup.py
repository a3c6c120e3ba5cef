"""Near duplicates against brute force where every path of the operator runs."""

import random
import re

import pytest

from folioforge.llm import neardup
from folioforge.session import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def grams(text, k):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    """Rows of (id, text): the size of each one's set and its component's least id, in the rows' order."""
    sets = [grams(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) or rows[i][0] is not None and rows[i][0] == rows[j][0]:
                up[top(i)] = top(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[top(i)] = min(name, least.get(top(i), name))
    return [(name, len(s), least.get(top(i)), name is not None and least[top(i)] == name) for i, ((name, _), s) in enumerate(zip(rows, sets, strict=True))]


def boilerplate(seed, n):
    """Texts that share long passages: near copies, and many that are just not near."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefgh", k=3))
    bases = [[word() for _ in range(chance.randint(40, 90))] for _ in range(3)]
    rows = []
    for i in range(n):
        text = list(chance.choice(bases))
        for _ in range(chance.choice([0, 1, 2, 4, 7, 12])):
            text[chance.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x", 1, 2) for i, t in rows], "doc_id long, text string, rep int, label string, t1 int, n int")


@pytest.mark.parametrize(("limit", "depth", "whole"), [(4, 2, 16), (8, 3, 0), (16, 4, 16), (4096, 12, 16)])
def test_all_paths_equal_brute_force(spark, monkeypatch, limit, depth, whole):
    monkeypatch.setattr(neardup, "WHOLE", whole)
    rows = boilerplate(limit, 260)
    chance = random.Random(1)
    chance.shuffle(rows)
    out = neardup.components_of(docs_of(spark, rows), k=2, limit=limit, depth=depth).collect()
    assert sorted(map(tuple, out)) == sorted(brute(rows, 2))


def test_heavy_groups_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 4000)
    rows = boilerplate(3, 150)
    out = neardup.components_of(docs_of(spark, rows), k=2).collect()
    assert sorted(map(tuple, out)) == sorted(brute(rows, 2))


def test_null_ids_and_repeated_rows_link_as_others_do(spark):
    base = [f"w{i}" for i in range(100)]
    text = lambda *new: " ".join([*new, *base[len(new) :]])
    rows = [(5, text("a")), (None, text("a", "b", "c", "d", "e", "f", "g")), (9, text(*"abcdefghijklmn")), (9, text(*"abcdefghijklmn")), (None, "all alone"), (None, "all alone"), (2, ""), (None, None), (7, "All alone"), (None, "by itself")]
    out = neardup.components_of(docs_of(spark, rows), k=2).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, brute(rows, 2)))
    kept = neardup.drop_duplicates(docs_of(spark, rows), k=2)
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 5), (False, 7), *[(True, 0)] * 5]


def test_near_pairs_connect_likeliest_first():
    import numpy as np

    chance = np.random.default_rng(5)
    places = chance.integers(0, 16, (600, 64)).astype(np.uint8)
    for i in range(1, 300):
        places[i] = places[0]
        change = chance.permutation(64)[: int(chance.integers(0, 12))]
        places[i, change] = (places[i, change] + 1) % 16
    part, i, j = neardup._connect(np.full(600, 50), places, np.arange(600), 80)
    assert len(set(part[:300])) == 1 and len(set(part[300:])) == 300 and len(i) == 299
    assert all(part[a] == part[b] for a, b in zip(i, j, strict=True))


def test_many_texts_of_one_template(spark):
    """Alike at about 0.7 and not linked, but for a few that are: nodes beyond the limit are compared whole at once."""
    chance = random.Random(17)
    word = lambda: "".join(chance.choices("abcdefgh", k=4))
    base, rows = [word() for _ in range(60)], []
    for i in range(700):
        text = list(base)
        for at in chance.sample(range(60), 5):
            text[at] = word()
        rows.append((i, " ".join(text)))
    for i in range(0, 700, 50):
        text = rows[i][1].split()
        text[chance.randrange(60)] = word()
        rows.append((1000 + i, " ".join(text)))
    out = neardup.components_of(docs_of(spark, rows), k=2, limit=64).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == sorted(brute(rows, 2))
