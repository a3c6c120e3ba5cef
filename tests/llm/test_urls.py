"""Link-graph propagation against a dense solution, and odd pages."""

import random

import numpy as np

from folioforge.llm import urls

RULES = (("allow", "good/"), ("block", "bad/x"))


def link(host, n=1):
    return f'<a href="http://{host}/p">x</a>' * n


def solved(pages, damping=0.85):
    """Trust and distrust of each host, by solving for the ranks."""
    edges, seeds = {}, {0: {}, 1: {}}
    for host, path, targets in pages:
        for to, n in targets.items():
            if to != host:
                edges[host, to] = edges.get((host, to), 0) + n
        kind = 0 if host == "good" or host.endswith(".good") else 1 if (host == "bad" or host.endswith(".bad")) and path.startswith("/x") else None
        if kind is not None:
            seeds[kind][host] = seeds[kind].get(host, 0) + 1
    names = sorted({h for h, _, _ in pages} | {h for e in edges for h in e})
    out = []
    for kind in (0, 1):
        walk = np.zeros((len(names), len(names)))
        for (a, b), n in edges.items():
            walk[(names.index(a), names.index(b)) if kind == 0 else (names.index(b), names.index(a))] = n
        seed = np.array([seeds[kind].get(h, 0) for h in names], float)
        seed /= max(1, seed.sum())
        sums = walk.sum(1)
        walk = np.where(sums[:, None] > 0, walk / np.maximum(sums, 1)[:, None], seed[None, :])
        rank = np.linalg.solve(np.eye(len(names)) - damping * walk.T, (1 - damping) * seed)
        out.append(dict(zip(names, rank, strict=True)))
    return out


def test_scores_equal_the_dense_solution(spark):
    chance = random.Random(2)
    hosts = ["good", "a.good", "bad", "b.bad", *[f"h{i}.test" for i in range(30)], "alone.test"]
    pages = []
    for _ in range(150):
        targets = {chance.choice(hosts[:-1]): chance.randint(1, 3) for _ in range(chance.choice([0, 1, 2]))}
        pages.append((chance.choice(hosts), chance.choice(["/x", "/y"]), targets))
    pages += [(f"far{i}.test", "/", {f"far{i - 1}.test": 1} if i else {"bad": 1}) for i in range(40)]
    rows = [(i, f"http://{h}{p}", "".join(link(t, n) for t, n in targets.items()), "x", 1.0) for i, (h, p, targets) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host string, trust double")
    trust, distrust = solved(pages)
    out = urls.judge(table, RULES).collect()
    assert len(out) == len(pages)
    for r in out:
        assert np.isclose(r.trust, trust.get(r.host, 0), rtol=1e-4, atol=0) and np.isclose(r.distrust, distrust.get(r.host, 0), rtol=1e-4, atol=0)
        if r.rule is None:
            assert r.verdict == ("block" if distrust.get(r.host, 0) > trust.get(r.host, 0) else "allow")
    assert {r.host for r in out if r.host.startswith("far") and r.verdict == "block"} == {f"far{i}.test" for i in range(40)}


def test_odd_pages(spark):
    rows = [(1, "http://bad/x", "<a href=>" * 3 + "<a href='//h.test'>" + link("h.test")), (1, "http://bad/x", None), (None, "http://h.test/" + "y" * 50_000, ""), (2, None, link("bad")), (3, "", None), (4, "http://other.test", link("bad") + "<a href='http://'>")]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()
    assert sorted([(r.page_id, r.host, len(r.path), r.rule, r.verdict) for r in out], key=str) == sorted(
        [(1, "bad", 2, "bad/x", "block"), (1, "bad", 2, "bad/x", "block"), (None, "h.test", 50_001, None, "allow"), (2, "", 0, None, "allow"), (3, "", 0, None, "allow"), (4, "other.test", 0, None, "block")], key=str
    )
