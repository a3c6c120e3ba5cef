"""Nested records, unique names, merged pages and progress against plain Python, with nulls, ties and empty tables."""

import json
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.operators import nested, resume, suffixes
from folioforge.session import new_folder
from folioforge.streaming import progress


# nested records


def brute(value, shape):
    out, ids = [], []

    def walk(v, path, kind):
        form = shape[kind][0]
        if form in ("object", "attributes") and not isinstance(v, dict) or form == "array" and not isinstance(v, list):
            out.append((path, "expected an object" if form != "array" else "expected an array"))
        elif form == "object":
            keys = shape[kind][1]
            missing, extra = sorted(k for k, (_, must) in keys.items() if must and k not in v), sorted(set(v) - set(keys))
            out.extend((path, f"{word} {','.join(names)}") for word, names in (("missing", missing), ("unsupported", extra)) if names)
            for k, (child, _) in keys.items():
                if k in v:
                    walk(v[k], f"{path}.{k}", child)
        elif form == "array":
            for k, x in enumerate(v):
                walk(x, f"{path}[{k}]", shape[kind][1])
        elif form == "attributes":
            for k, x in v.items():
                if not re.fullmatch("[a-z][a-z0-9_]*", k) or k in nested.FORBIDDEN:
                    out.append((f"{path}.{k}", "unsupported field"))
                elif isinstance(x, dict | list):
                    out.append((f"{path}.{k}", "not a scalar"))
                elif isinstance(x, str) and len(x) > 32767:
                    out.append((f"{path}.{k}", "not a cell's text"))
        elif not isinstance(v, str):
            out.append((path, "expected a string"))
        elif len(v) > 32767:
            out.append((path, "not a cell's text"))
        elif form in ("filled", "id") and not v.strip(" "):
            out.append((path, "blank"))
        elif form == "id":
            if v in ids:
                out.append((path, "duplicate id"))
            ids.append(v)

    if value is None:
        return [("$", "not a record")]
    walk(value, "$", "root")
    return sorted(out)


def made(chance, shape, kind="root"):
    """A record of the shape with faults here and there."""
    if chance.random() < 0.03:
        return chance.choice([None, 3, "x", [], {}, True, 1.5, [{}], {"z": 1}])
    form = shape[kind][0]
    if form == "object":
        out = {k: made(chance, shape, child) for k, (child, must) in shape[kind][1].items() if chance.random() < (0.97 if must else 0.4)}
        return out | ({"odd key": 1} if chance.random() < 0.03 else {})
    if form == "array":
        return [made(chance, shape, shape[kind][1]) for _ in range(chance.choice([0, 1, 2, 3]))]
    if form == "attributes":
        return {chance.choice(["lot", "kg", "instance", "Bad", "a_1"]): chance.choice([1, None, "t", True, 2.5, [], {"q": 1}]) for _ in range(chance.randrange(3))}
    return chance.choice(["a", "b", "c", "d", "", " "]) if form == "id" else chance.choice(["n", "", "long " * 7000]) if chance.random() < 0.05 else "name"


@pytest.mark.parametrize("shape", [nested.FLAT, nested.DEEP, {"root": ("array", "node"), "node": ("object", {"id": ("id", True), "under": ("root", False)}), "id": ("id",)}])
def test_every_fault_of_any_depth(spark, shape):
    chance = random.Random(5)
    records = [(k % 40, json.dumps(made(chance, shape))) for k in range(60)] + [(900, None), (901, "{cut"), (None, "7")]
    deep = []
    for k in range(12):
        deep = [{"id": str(k % 9), "under": deep}]
    records.append((902, json.dumps(deep)))
    frame = spark.createDataFrame(records, "id long, text string").select("id", F.try_parse_json("text").alias("value"))
    expected = []
    for k, text in records:
        value = None
        if text and text != "{cut":
            value = json.loads(text)
        faults = brute(value, shape) if value is not None or text is None or text == "{cut" else brute_null(shape)
        expected += [(k, *f) for f in faults]
    assert sorted(map(str, (tuple(r) for r in nested.validate(frame, shape).collect()))) == sorted(map(str, expected))


def brute_null(shape):
    return [("$", "expected an object" if shape["root"][0] == "object" else "expected an array")]


def test_no_records(spark):
    assert nested.validate(spark.createDataFrame([], "id long, text string").select("id", F.try_parse_json("text").alias("value")), nested.FLAT).collect() == []


# names


def fold_names(rows):
    used, out = defaultdict(set), []
    for table, place, base in sorted(rows, key=lambda r: r[1]):
        name, k = base or "", 2
        while name in used[table]:
            name, k = f"{base or ''}_{k}", k + 1
        used[table].add(name)
        out.append((table, place, base, name))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_unique_names(spark, seed):
    chance = random.Random(seed)
    bases = ["x", "x_2", "x_3", "x_2_2", "x_2_3", "y", "", "_2", None, "x_10", "x_11"]
    rows = [(chance.choice([None, "", "t"]), place, chance.choices(bases, [9, 4, 4, 3, 1, 2, 2, 2, 1, 1, 1])[0]) for place in range(180)]
    frame = spark.createDataFrame(rows, "name_of string, o long, base string").withColumn("s", F.lit("clash"))
    out = suffixes.unique_names(frame.withColumnRenamed("name_of", "t"), "t", "o", "base")
    assert out.columns == ["t", "o", "base", "s", "name"]
    assert sorted(((r.t, r.o, r.base, r.name) for r in out.collect()), key=str) == fold_names(rows)


def test_no_names(spark):
    assert suffixes.unique_names(spark.createDataFrame([], "t string, o long, base string"), "t", "o", "base").collect() == []


# merged pages


def test_merged_pages_and_gaps(spark):
    chance = random.Random(2)
    rows = [(chance.randrange(40), chance.randrange(4), chance.randrange(1, 15), chance.random() < 0.6, f"w{k}") for k in range(900)]
    rows += [(None, 0, 1, True, "x"), (1, None, 1, True, "x"), (1, 0, None, True, "x"), (77, 0, 1, False, "only"), (78, 0, 3, True, None)]
    pages, missing = {}, []
    for doc in {r[0] for r in rows} - {None}:
        last = None
        for piece in range(4):
            own = [r for r in rows if r[:2] == (doc, piece) and r[2] is not None and r[3]]
            if not own or last is not None and max(r[2] for r in own) <= last:
                continue
            last = max(r[2] for r in own)
            for page in {r[2] for r in own}:
                pages.setdefault((doc, page), (piece, min((r[4] for r in own if r[2] == page), key=lambda w: (w is not None, w))))
    merged = resume.merged_pages(spark.createDataFrame(rows, "doc long, piece int, page int, complete boolean, words string"))
    assert {(r.doc, r.page): (r.piece, r.words) for r in merged.collect()} == pages
    for doc in {d for d, _ in pages}:
        have = {p for d, p in pages if d == doc}
        lack = [p for p in range(1, max(12, *have) + 1) if p not in have]
        missing += [(doc, p) for p in lack]
    found = resume.gaps(merged, F.lit(12)).collect()
    assert sorted((r.doc, p) for r in found for p in range(r["first"], r["last"] + 1)) == sorted(missing)
    assert all((r.doc, r["last"] + 1) not in set(missing) for r in found)


# progress


def test_progress_over_batches(spark):
    chance = random.Random(9)
    kinds = ("checked", "upgraded")
    events = [(chance.choice(["hot", "a", "b"]), seq, chance.choices(["reset", "checked", "upgraded", "other"], [1, 20, 9, 3])[0], chance.choice([None, 1, 2, 40_000, 70_000, chance.randrange(90_000)])) for seq in range(700)]
    events += [(None, 701, "checked", 1), ("a", None, "checked", 1), ("late", 702, "reset", None)]
    place = new_folder(spark, "progress")
    schema = "doc string, seq long, kind string, page long"
    for part in (events[:200], events[200:201], [], events[201:]):
        chance.shuffle(part)
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{place}/log")
        progress.append_progress(spark.readStream.schema(schema).parquet(f"{place}/log"), kinds, place)
    state = {}
    for doc, seq, kind, page in sorted((e for e in events if None not in e[:2]), key=lambda e: e[1]):
        s = state.setdefault(doc, [0, 0, {k: set() for k in kinds}])
        s[1] = seq
        if kind == "reset":
            s[0], s[2] = s[0] + 1, {k: set() for k in kinds}
        elif kind in kinds and page is not None:
            s[2][kind].add(page)
    got = {r.doc: (r.attempts, r["last"], r.checked, r.upgraded) for r in progress.progress(spark, place, kinds).collect()}
    assert got == {d: (n, last, len(p["checked"]), len(p["upgraded"])) for d, (n, last, p) in state.items()}


@pytest.mark.parametrize("shape", [nested.FLAT, nested.DEEP])
def test_shapes_that_end_are_one_pass(spark, monkeypatch, shape):
    monkeypatch.setattr(nested, "kept", lambda *_: pytest.fail("a level was written"))
    chance = random.Random(7)
    records = [(k, json.dumps(made(chance, shape))) for k in range(20)]
    frame = spark.createDataFrame(records, "id long, text string").select("id", F.try_parse_json("text").alias("value"))
    expected = [(k, *f) for k, text in records for f in (brute(json.loads(text), shape) if text != "null" else brute_null(shape))]
    assert sorted(tuple(r) for r in nested.validate(frame, shape).collect()) == sorted(expected)


def test_progress_rows_hold_no_bitmaps(spark):
    events = spark.createDataFrame([("a", k, "checked", 40_000 * k) for k in range(50)] + [("a", 60, "other", 3)], "doc string, seq long, kind string, page long")
    made = progress.delta(events, ("checked",))
    assert made.count() == 51 and "binary" not in {t for _, t in made.dtypes}
