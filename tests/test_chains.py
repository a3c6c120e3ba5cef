"""Decisions by the last accepted row against folds, with ties, nulls, repeats, one hot key and empty tables."""

import random

import pytest

from folioforge.operators import chains
from folioforge.operators.chains import attempts, packed, versioned

ROWS = "k string, j long, at long, id long, ok boolean, node int, span int"


def fold_attempts(rows, wait):
    state, out = {}, {}
    for k, j, at, i, ok, *_ in sorted((r for r in rows if None not in r[:4]), key=lambda r: (r[2], r[3])):
        last = state.get((k, j))
        if last and last[1]:
            out[k, j, i] = "done"
        elif last is None or at >= last[0] + wait:
            out[k, j, i] = "attempt"
            state[k, j] = (at, bool(ok))
        else:
            out[k, j, i] = "waiting"
    return out


@pytest.mark.parametrize("seed, spread, wait, good", [(1, 3000, 10, 0.02), (2, 40, 10, 0.0), (3, 500, 1, 0.1), (4, 10**12, 7 * 10**9, 0.01)])
def test_attempts(spark, seed, spread, wait, good):
    chance = random.Random(seed)
    rows = [(chance.choice(["hot"] * 3 + ["a", "b", ""]), chance.choice([1, 1, 2]), chance.randrange(-spread, spread), i, chance.choice([None, False]) if chance.random() > good else True, 0, 0) for i in range(600)]
    rows += [(None, 1, 5, 9001, True, 0, 0), ("a", None, 5, 9002, True, 0, 0), ("a", 1, None, 9003, True, 0, 0), ("lone", 1, 5, 9004, None, 0, 0)]
    out = attempts(spark.createDataFrame(rows, ROWS), ["k", "j"], "at", "id", "ok", wait)
    assert out.columns == ["k", "j", "at", "id", "ok", "node", "span", "decision"]
    expected = fold_attempts(rows, wait)
    got = out.collect()
    assert len(got) == len(rows)
    assert {r.id: r.decision for r in got} == {r[3]: expected.get((r[0], r[1], r[3])) for r in rows}


def test_attempts_of_nothing(spark):
    assert attempts(spark.createDataFrame([], ROWS), ["k"], "at", "id", "ok", 5).collect() == []


MOVES = (("new", "go", "run"), ("run", "stop", "new"), ("run", "end", "over"), ("new", "end", "over"))


def fold_versions(objects, changes, moves):
    state, out = {k: (v, s) for k, v, s in objects if k is not None and v is not None}, {}
    for k, place, expected, action in sorted((c for c in changes if None not in c), key=lambda c: c[1]):
        version, status = state.get(k, (None, None))
        after = status if moves is None else {(b, a): c for b, a, c in moves}.get((status, action))
        if version is not None and version == expected and (moves is None or after is not None):
            state[k] = (version + 1, after)
            out[k, place] = (version + 1, after)
    return out


@pytest.mark.parametrize("moves", [MOVES, None])
def test_versions(spark, moves):
    chance = random.Random(8)
    objects = [("hot", 0, "new"), ("b", 2, "run"), ("c", 0, "over"), ("d", None, "new"), ("e", 1, "unheard of")]
    changes = [(chance.choice(["hot"] * 4 + ["b", "c", "d", "e", "unknown"]), place, chance.choice(range(12)), chance.choice(["go", "stop", "end", "fly"])) for place in range(900)]
    changes += [(None, 5000, 0, "go"), ("hot", None, 0, "go"), ("hot", 5001, None, "go"), ("hot", 5002, 0, None)]
    out = versioned(spark.createDataFrame(objects, "key string, version long, status string"), spark.createDataFrame(changes, "key string, place long, expected long, action string"), moves).collect()
    expected = fold_versions(objects, changes, moves)
    assert len(out) == len(changes) and expected
    for r in out:
        assert (r.accepted, r.version, r.status) == ((True, *expected[r.key, r.place]) if (r.key, r.place) in expected else (False, None, None)), r


def test_versions_of_nothing(spark):
    none = spark.createDataFrame([], "key string, place long, expected long, action string")
    assert versioned(spark.createDataFrame([], "key string, version long, status string"), none, MOVES).collect() == []
    assert versioned(spark.createDataFrame([("a", 0, "new")], "key string, version long, status string"), none).collect() == []


def fold_packed(items, budget):
    state, out = {}, {}
    for k, place, size in sorted((i for i in items if None not in i[:2]), key=lambda i: i[1]):
        size = max(size or 0, 0)
        number, held = state.get(k, (0, None))
        if held is None or held + size > budget:
            number, held = number + 1, 0
        state[k] = number, held + size
        out[k, place] = number
    return out


@pytest.mark.parametrize("seed, budget, most", [(1, 10, 7), (2, 10, 40), (3, 1, 2), (4, 1000, 30), (5, 0, 1)])
def test_packed(spark, seed, budget, most):
    chance = random.Random(seed)
    items = [(chance.choice(["hot", "hot", "b", ""]), place, chance.choice([None, 0, -3, *range(most + 1)])) for place in range(-100, 400)]
    items += [(None, 1000, 5), ("b", None, 5)]
    out = packed(spark.createDataFrame(items, "k string, node long, size int"), ["k"], "node", "size", budget)
    assert out.columns == ["k", "node", "size", "request"]
    expected = fold_packed(items, budget)
    got = out.collect()
    assert len(got) == len(items) and {(r.k, r.node): r.request for r in got if r.request} == expected


def test_packed_of_nothing(spark):
    assert packed(spark.createDataFrame([], "k string, place long, size int"), ["k"], "place", "size", 5).collect() == []


@pytest.mark.parametrize("seed, budget, most, block", [(1, 10, 7, 3), (2, 10, 40, 8), (3, 0, 1, 5), (4, 1000, 30, 16), (5, 6, 30, 1), (6, 50, 2, 7)])
def test_packed_over_many_blocks(spark, seed, budget, most, block):
    chance = random.Random(seed)
    items = [(chance.choice(["hot"] * 4 + ["b", "", f"k{place % 90}"]), place, chance.choice([None, 0, 0, -3, *range(most + 1)])) for place in range(500)] + [(None, 1000, 5), ("b", None, 5)]
    got = packed(spark.createDataFrame(items, "k string, node long, size int"), ["k"], "node", "size", budget, block).collect()
    assert len(got) == len(items) and {(r.k, r.node): r.request for r in got if r.request} == fold_packed(items, budget)


def test_packed_doubles_over_blocks_only(spark, monkeypatch):
    seen, reached = [], chains.reached
    monkeypatch.setattr(chains, "reached", lambda starts, jumps: seen.append(jumps.count()) or reached(starts, jumps))
    items = spark.range(20_000).selectExpr("id % 2 AS k", "id AS place", "id % 7 AS size")
    assert packed(items, ["k"], "place", "size", 12).count() == 20_000
    assert sum(seen) < 1000
