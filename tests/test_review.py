"""Groups of date parts against a fold in Python."""

import datetime
import random
from itertools import groupby

from folioforge.operators import review
from folioforge.plans import adapters, record_queries

FOLDER = "/root/testdata/sf0.01"


def test_date_groups_equal_a_fold(spark):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    fields = adapters.frame(spark, FOLDER, record_queries.DATE_FIELDS)
    found = review.date_groups(fields, "l_orderkey", order).collect()
    key = lambda r: (r.l_orderkey, *(r[c] for c in order), r.prefix, r.unit or "", r.value)
    expected, bad = [], []
    for order_key, rows in groupby(sorted(found, key=key), key=lambda r: r.l_orderkey):
        n, prefix, parts = 0, None, {}
        rows = sorted(rows, key=lambda r: (*(r[c] for c in order), r.prefix, r.unit is not None, r.unit or "", r.value))
        groups = []
        for r in rows:
            if r.unit is None:
                prefix, parts = None, {}
            elif r.prefix == prefix and r.unit not in parts:
                parts[r.unit] = r.value
            else:
                n, prefix, parts = n + 1, r.prefix, {r.unit: r.value}
                groups.append((n, parts))
            expected.append((*key(r), None if r.unit is None else n))
        for n, parts in groups:
            if len(parts) == 3:
                try:
                    datetime.date(*(int(parts[u]) for u in ("year", "month", "day")))
                except ValueError:
                    bad.append((order_key, n))
    assert sorted(map(str, expected)) == sorted(str((*key(r), r.group)) for r in found)
    out = record_queries.date_islands(spark, FOLDER).collect()
    assert sorted((r.l_orderkey, r.group) for r in out) == sorted(bad) and len(bad) > 20


def test_boxes_that_overlap(spark):
    chance = random.Random(4)
    inf, nan = float("inf"), float("nan")

    def box():
        x, y = chance.uniform(-50, 300), chance.uniform(-50, 300)
        return [x, y, x + chance.choice([0, 5, 40, 120, -3]), y + chance.choice([1, 30, 90])]

    odd = [None, [], [1.0, 2.0, 3.0], [0.0, 0.0, inf, 5.0], [0.0, nan, 5.0, 5.0], [0.0, 0.0, 64.0, 64.0], [64.0, 0.0, 70.0, 9.0]]
    fields = [(k, chance.choice([1, 2, None]), b) for k, b in enumerate([*odd, *[box() for _ in range(120)]])]
    blocks = [(chance.choice([1, 2, 2, None]), b) for b in [*odd, *[box() for _ in range(60)]]]
    right = lambda b: b is not None and len(b) == 4 and all(abs(v) < inf for v in b) and b[0] < b[2] and b[1] < b[3]
    meet = lambda a, b: right(a) and right(b) and min(a[2], b[2]) > max(a[0], b[0]) and min(a[3], b[3]) > max(a[1], b[1])
    expected = sorted(k for k, p, a in fields if p is not None and any(p == q and meet(a, b) for q, b in blocks))
    out = review.overlapping(spark.createDataFrame(fields, "id int, page int, box array<double>"), spark.createDataFrame(blocks, "page int, box array<double>"), "page", 50.0)
    assert sorted(r.id for r in out.collect()) == expected and expected


def test_review_select_meets_all_boxes_of_fifty_pages(spark):
    rows = [(r.vec_id, r.box, r.score) for r in record_queries._boxes(spark, FOLDER).collect()]
    blocks = {}
    for k, box, score in rows:
        if k % 2 == 0 and score < 0.55:
            blocks.setdefault(k % 50, []).append(box)
    meet = lambda a, b: min(a[2], b[2]) > max(a[0], b[0]) and min(a[3], b[3]) > max(a[1], b[1])
    expected = sorted((k, k % 50 - 1) for k, box, _ in rows if k % 2 and any(meet(box, b) for b in blocks.get(k % 50 - 1, ())))
    assert sorted((r.vec_id, r.page) for r in record_queries.review_select(spark, FOLDER).collect()) == expected and expected
