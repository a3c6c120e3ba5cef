"""Places in an order over a whole table, and pages of lines, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators.order import natural, ranked
from folioforge.operators.pages import page_of_lines


@pytest.mark.parametrize("same", [0.0, 0.7])
def test_ranks(spark, same):
    chance = random.Random(1)
    rows = [(None if chance.random() < 0.1 else "hot" if chance.random() < same else chance.choice("abc"), k) for k in range(1000)]
    out = ranked(spark.createDataFrame(rows, "name string, id long").repartition(7), [F.col("name").desc_nulls_first(), F.col("id")])
    expected = sorted(rows, key=lambda r: r[1])
    expected.sort(key=lambda r: "\uffff" if r[0] is None else r[0], reverse=True)
    assert [(r.name, r.id) for r in sorted(out.collect(), key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 1001))
    assert ranked(spark.createDataFrame([], "id long"), [F.col("id")]).collect() == []


def test_natural_names(spark):
    names = ["a2", "A10", "á3", "a02", "b", "a", "", "10", "9", "a 1", None, "Z1x10", "z1X9", "a" + "9" * 19]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in rows.orderBy(natural(F.col("name")).asc_nulls_first(), "name").collect()]
    assert got == [None, "", "9", "10", "a", "a 1", "a02", "a2", "á3", "A10", "a" + "9" * 19, "b", "z1X9", "Z1x10"]


def test_pages_of_lines(spark):
    chance = random.Random(5)
    mark = lambda n: f"% X_PAGE_COMPLETED: {n}/9"
    texts = ["", "one", mark(3), "a\n" + mark(1) + "\nb\nc\n" + mark(2) + "\n"]
    texts += ["\n".join(chance.choice(["line", "", mark(chance.randrange(9))]) for _ in range(chance.randrange(30))) for _ in range(60)]
    expected = []
    for text in texts:
        lines, out = text.split("\n"), []
        pages = [int(x.split(":")[1].split("/")[0]) if x.startswith("%") else None for x in lines]
        for k in range(len(lines)):
            ahead = [p for p in pages[k:] if p is not None]
            before = [p for p in pages if p is not None]
            out.append(ahead[0] if ahead else before[-1] + 1 if before else 4)
        expected.append(out)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    assert [r.p for r in rows.select("id", page_of_lines(F.col("text"), 4).alias("p")).orderBy("id").collect()] == expected
