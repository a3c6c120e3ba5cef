"""Connected components by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.llm._store import Scratch, light


def _roots(step: DataFrame, n: int, scratch: Scratch, rounds: int) -> DataFrame:
    """Follows ``label``, which is never above its ``node``, to the node that names itself; chains shrink fourfold each round."""
    for _ in range(rounds):
        moved = Observation()
        up = light(step.select(F.col("node").alias("label"), F.col("label").alias("second")), n)
        twice = step.join(up, "label")
        up = light(twice.select(F.col("node").alias("second"), F.col("second").alias("fourth")), n)
        new = twice.join(up, "second").observe(moved, F.count_if(F.col("label") != F.col("fourth")).alias("n"))
        new = scratch.keep(new.select("node", F.col("fourth").alias("label")), "labels", n)
        scratch.drop(step)
        step = new
        if not moved.get["n"]:
            return step
    raise RuntimeError(f"labels did not settle in {rounds} rounds")


def components(edges: DataFrame, scratch: Scratch, most: int | None = None, rounds: int = 60) -> tuple[DataFrame | None, int]:
    """The smallest reachable node of each node that has an edge to another, and how many these are.

    ``edges`` has integer columns ``a`` and ``b``, and at most ``most`` rows if that is
    known; loops and repeats are harmless.
    Each round points a node at its least neighbour (a partial aggregate, so a hub's
    edges never meet in one task), follows the pointers to their roots and draws the
    edges between roots, which leaves at most half of the nodes that have edges. A
    component's least node is always a root. Labels travel to the edges while they
    are few (``light``), and meet them in shuffles beyond. Returns ``node`` and
    ``label``, or None without edges.
    """

    def drawn(a: str, b: str, found: DataFrame, most: int | None) -> tuple[DataFrame, int]:
        ends = found.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        return scratch.counted(ends.distinct(), "edges", most)

    edges, m = drawn("a", "b", edges, most)
    labels, total = None, 0
    for _ in range(rounds):
        if not m:
            return labels, total
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        step, n = scratch.counted(near.select("node", F.least("node", "label").alias("label")), "labels", 2 * m)
        step = _roots(step, n, scratch, rounds)
        if labels is None:
            labels, total = step, n
        else:
            further = light(step.select(F.col("node").alias("label"), F.col("label").alias("further")), n)
            labels = scratch.keep(labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels", total)
        at = [light(step.select(F.col("node").alias(c), F.col("label").alias(f"root_{c}")), n) for c in ("a", "b")]
        edges, m = drawn("root_a", "root_b", edges.join(at[0], "a").join(at[1], "b"), m)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
