"""Greedy plans against a loop in Python: pinned sources, ties, empty groups."""

import random

from pyspark.sql import functions as F

from folioforge.operators.jobs import assign


def greedy(rows, workers):
    load = [[0, 0, w, []] for w in range(1, workers + 1)]
    for pinned, pages, source in sorted(((not p, -n, s) for s, n, p in rows)):
        chosen = min(load, key=lambda w: (w[0], w[1], w[2])) if pinned else load[0]
        chosen[0] -= pages
        chosen[1] += 1
        chosen[3].append(source)
    return {w: (pages, files, sorted(sources)) for pages, files, w, sources in load}


def test_plans(spark):
    chance = random.Random(2)
    rows = [(f"g{k % 7}", f"{k:03d}.pdf", chance.choice([1, 5, 5, 40]), chance.random() < 0.1) for k in range(200)]
    frame = spark.createDataFrame(rows, "grp string, source string, pages long, pinned boolean")
    for workers in (1, 3, 5):
        got = {}
        for r in assign(frame, workers, "grp").collect():
            got.setdefault(r.grp, {})[r.worker] = (r.pages, r.files, list(r.sources))
        assert got == {g: greedy([x[1:] for x in rows if x[0] == g], workers) for g in {x[0] for x in rows}}
    assert assign(frame.where(F.lit(False)), 3, "grp").collect() == []


def test_a_large_plan_of_nulls_and_ties(spark):
    chance = random.Random(3)
    rows = [(chance.choice([None, "g"]), f"{k:05d}.pdf", chance.choice([0, 1, 2, 3, 50]), chance.random() < 0.01) for k in range(12_000)]
    got = {(r.grp, r.worker): (r.pages, r.files, list(r.sources)) for r in assign(spark.createDataFrame(rows, "grp string, source string, pages long, pinned boolean"), 3, "grp").collect()}
    assert got == {(g, w): plan for g in (None, "g") for w, plan in greedy([x[1:] for x in rows if x[0] == g], 3).items()}


def test_plans_fold_sizes_only(spark):
    frame = spark.range(1000).selectExpr("'g' AS grp", "cast(id as string) AS source", "id % 7 AS pages", "false AS pinned")
    plan = assign(frame, 3, "grp")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "array_append" not in plan
