"""Near-duplicate vectors against brute force where every path of the operator runs."""

import numpy as np
import pytest

from folioforge.llm import vectors
from folioforge.session import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def brute(rows, threshold=0.95):
    """Rows of (id, vector): links, least id and kept of each, in the rows' order."""
    ok = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v in rows]
    unit = [np.array(v) / np.linalg.norm(v) if good else None for (_, v), good in zip(rows, ok, strict=True)]
    n, up = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                up[top(i)] = top(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[top(i)] = min(name, least.get(top(i), name))
    return [(name, n[i], least.get(top(i)), name is not None and least[top(i)] == name) for i, (name, _) in enumerate(rows)]


def clustered(seed, groups, dim=64):
    """Groups of (size, noise): near each other or at the threshold."""
    chance = np.random.default_rng(seed)
    rows = []
    for size, noise in groups:
        centre = chance.normal(size=dim)
        rows += [(centre + noise * chance.normal(size=dim)).astype(np.float32).tolist() for _ in range(size)]
    rows += chance.normal(size=(60, dim)).astype(np.float32).tolist()
    return [(i, rows[k]) for i, k in enumerate(chance.permutation(len(rows)).tolist())]


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, rep int, cell int")


@pytest.mark.parametrize("limit", [8, 64, 512])
def test_equals_brute_force(spark, limit):
    rows = clustered(limit, [(120, 0.05), (60, 0.12), (40, 0.2), (5, 0.1), (3, 0.01)])
    out = sorted(map(tuple, vectors.links_of(table(spark, rows), limit=limit).collect()))
    expected = brute(rows)
    found, true = sum(r[1] for r in out), sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(out, expected, strict=True))
    assert found >= 0.97 * true and sum(a == b for a, b in zip(out, expected, strict=True)) >= 0.97 * len(rows)


def test_tight_groups_are_counted_by_rings(spark):
    rows = clustered(3, [(150, 0.01), (90, 0.1)])
    assert sorted(map(tuple, vectors.links_of(table(spark, rows), limit=20).collect())) == sorted(brute(rows))


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.02]
    rows = [(1, v), (None, [1.0, 2.0, 3.01]), (2, w), (2, w), (None, [5.0, -1.0, 0.0]), (None, [5.0, -1.0, 0.1]), (7, None), (8, []), (9, [0.0, 0.0, 0.0]), (10, [1.0, None, 3.0]), (11, [float("nan"), 1.0, 2.0]), (12, [float("inf"), 1.0, 2.0]), (13, [-1.0, -2.0, -3.0]), (14, [1e-30, 2e-30, 3e-30]), (15, [1.0, 2.0, 3.0, 0.0])]
    for kind in ("float", "double"):
        out = vectors.links_of(table(spark, rows, kind)).collect()
        assert sorted(map(str, map(tuple, out))) == sorted(map(str, brute(rows)))
    assert vectors.links_of(table(spark, rows).where("false")).collect() == []
