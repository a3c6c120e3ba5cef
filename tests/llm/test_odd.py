"""Odd tables: nulls, repeats, empty and clashing columns, with the values that the docstrings define."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from folioforge.llm import chunks, mixing, quality, toxicity
from folioforge.llm._text import SPACE
from folioforge.session import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, a int, b int, id string, label int, fold int, score double, k int, keeper long, start int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3, 4, 0.5, 6, 7, 8) for i, t in rows], CLASHING)


def prose(seed, n):
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefghijklmnop", k=chance.randint(2, 9))) for _ in range(n))


ROWS = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id at all"), (4, " \t\n"), (5, prose(5, 9000))]


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, t, "clash", 1) for i, q, t in rows], "doc_id long, quality int, toxic int, text string, fold int")


# quality


def test_quality_without_labels_or_with_one_grade(spark):
    for labels, grade in (([], 1.0), ([(1, 2, 0), (3, 2, 0), (5, 2, 0), (None, 0, 0), (2, None, 0)], 2.0)):
        out = quality.grade(clashing(spark, ROWS), labels_of(spark, labels)).collect()
        assert len(out) == len(ROWS) and all(r.expected_grade == grade and r.selected for r in out)
    kept = quality.select(clashing(spark, ROWS), labels_of(spark, []))
    assert kept.columns == clashing(spark, ROWS).columns and kept.count() == len(ROWS)


def test_repeated_labels_count_as_the_greatest(spark):
    rows = [(i, "spam spam click" if i % 2 else "careful theorem method") for i in range(200)]
    labels = [(i, (i + 1) % 2, 0) for i, _ in rows]
    low = [(i, 0, 0) for i, _ in rows]
    once = quality.grade(clashing(spark, rows), labels_of(spark, labels)).collect()
    again = quality.grade(clashing(spark, rows), labels_of(spark, labels + low + [(1, None, None), (None, 1, 1)])).collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, again))
    assert {r.doc_id for r in once if r.selected} == {i for i in range(200) if i % 2 == 0}


def test_ordinal_fit_recovers_its_own_model():
    chance = np.random.default_rng(7)
    x = chance.normal(size=(6000, 6)).astype(np.float32)
    weights, thresholds = np.array([1.5, -1.0, 0.5, 0, 0, 2.0]), np.array([-2.0, 0.5, 1.0])
    tails = 1 / (1 + np.exp(-((x @ weights)[:, None] - thresholds)))
    grade = (chance.random((6000, 1)) < tails).sum(1)
    model = quality.fit(x, grade, steps=600)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    assert np.abs(model.thresholds - thresholds).max() < 0.2 and np.abs(model.weights - weights).max() < 0.2
    assert np.allclose(model.tails(x[:50]), 1 / (1 + np.exp(-((x[:50] @ model.weights)[:, None] - model.thresholds))))


# toxicity


def test_toxicity_without_labels_or_with_one_label(spark):
    out = toxicity.scores(clashing(spark, ROWS), labels_of(spark, [])).collect()
    assert len(out) == len(ROWS) and all(r.score == 0.0 and r.predicted == 0 for r in out)
    out = toxicity.scores(clashing(spark, ROWS), labels_of(spark, [(i, 0, 1) for i in (1, 3, 5, 7, 9)])).collect()
    assert len({r.score for r in out}) == 1


def test_toxicity_of_planted_words(spark):
    chance = random.Random(2)
    rows = [(i, " ".join(w + (" vilescum" if i % 4 == 0 and k % 9 == 0 else "") for k, w in enumerate(prose(i, chance.randint(20, 60)).split()))) for i in range(600)]
    out = toxicity.scores(docs_of(spark, rows + ROWS[:3]), labels_of(spark, [(i, 0, int(i % 4 == 0)) for i, _ in rows])).collect()
    right = [r.predicted == int(r.doc_id % 4 == 0 and r.doc_id < 600) for r in out if r.doc_id is not None]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in out)


# repeated passages


def brute_passages(rows, least):
    """The operator's own chunks, grouped in plain Python."""
    found, holders = {}, defaultdict(set)
    for n, (name, text) in enumerate(rows):
        data = np.frombuffer((text or "").encode(), np.uint8)
        _, first, end = chunks.cuts(data, np.array([0, len(data)]), 20, 2048) if len(data) else (None, [], [])
        found[n] = [(int(a), int(b), bytes(data[a:b])) for a, b in zip(first, end, strict=True)]
        for _, _, piece in found[n]:
            if name is not None:
                holders[piece].add(name)
    out = []
    for n, (name, text) in enumerate(rows):
        gap = SPACE[np.frombuffer((text or "").encode(), np.uint8)]
        begins = np.r_[0, np.cumsum(~gap & np.r_[True, gap[:-1]])] if len(gap) else np.zeros(1, int)
        run = []
        for piece in [*found[n], None]:
            keeper = min(holders[piece[2]]) if piece and name is not None and len(holders[piece[2]]) > 1 else None
            if keeper is not None and keeper != name:
                run.append((*piece[:2], keeper, int(begins[piece[1]] - begins[piece[0]])))
            elif run:
                words, of = sum(r[3] for r in run), defaultdict(int)
                for r in run:
                    of[r[2]] += r[3]
                top, most = max(of.items(), key=lambda x: (x[1], -x[0]))
                if words >= least and 2 * most >= words:
                    out.append((name, top, run[0][0], run[-1][1], words))
                run = []
    return sorted(out)


def test_passages_equal_brute_force_and_leave_mosaics(spark):
    passages = [prose(900 + i, 70) for i in range(4)]
    rows = [(i, f"{prose(i, 80)} {passages[i % 4]} {prose(100 + i, 60)}") for i in range(24)]
    pieces = [prose(300 + i, 26) for i in range(6)]
    rows += [(50 + i, f"{prose(400 + i, 40)} {p} {prose(500 + i, 40)}") for i, p in enumerate(pieces)] + [(80, " ".join(pieces))]
    rows += [(90, None), (91, ""), (None, passages[0]), (92, "x" * 9000), (93, "x" * 9000)]
    out = chunks.repeats(clashing(spark, rows)).collect()
    assert sorted((r.doc_id, r.keeper_id, r.start, r.end, r.n_words) for r in out) == brute_passages(rows, 32)
    assert {r.doc_id for r in out} == set(range(4, 24))
    left = chunks.drop_repeats(clashing(spark, rows))
    assert left.columns == clashing(spark, rows).columns and left.count() == len(rows)
    assert {r.doc_id: r.text for r in left.collect()}[80] == dict(rows)[80]


# mixing


def test_a_cut_document_keeps_its_lines(spark):
    text = " one\ttwo\n\nthree  four\nfive "
    frame = docs_of(spark, [(1, text)])
    from pyspark.sql import functions as F

    cut = [frame.select(mixing.first_words(F.col("text"), F.lit(n))).first()[0] for n in range(7)]
    assert cut == ["", " one", " one\ttwo", " one\ttwo\n\nthree", " one\ttwo\n\nthree  four", " one\ttwo\n\nthree  four\nfive", " one\ttwo\n\nthree  four\nfive"]


# pipeline


def test_stages_on_odd_documents(spark, tmp_path):
    folder = str(tmp_path)
    item = prose(77, 40)
    labels_of(spark, []).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    base = prose(8, 60).split()
    rows = [*ROWS, (10, f"{prose(9, 50)} {item}"), (11, " ".join(base)), (12, " ".join([*base[:-1], "end"])), (6, "one")]
    docs = docs_of(spark, rows)
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and stage(spark, docs.where("false"), folder).collect() == []
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        ids.append(sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()))
    assert ids[0] == sorted((i is None, i or 0) for i, _ in rows)
    assert ids[1] == [(False, i) for i in (1, 2, 3, 4, 5, 10, 11)] + [(True, 0)]
    assert ids[2] == [(False, i) for i in (1, 2, 3, 4, 5, 11)] + [(True, 0)]
    assert {(False, i) for i in (1, 2, 4)} <= set(ids[3])
    out = corpus_pipeline.token_ids(spark, docs, folder).collect()
    assert len(out) == docs.count() and all(r.n_tokens == 1 for r in out if r.doc_id in (1, 2, 4))
    assert pa.compute.sum(pa.array([r.n_tokens for r in out])).as_py() > sum(len(re.findall(r"\S+", r.text or "")) for r in docs.collect())


def test_stages_with_clashing_columns_and_a_text_of_megabytes(spark, tmp_path):
    """Columns named as those that operators add pass through; the long text, twice there, is one document after the second stage."""
    folder = str(tmp_path)
    labels_of(spark, []).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(77, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    long = " ".join(f"{prose(k % 50, 12)} {k}" for k in range(60_000))
    assert len(long) > 4 << 20
    schema = "doc_id long, text string, lang string, source string, n_chars long, rep int, label string, t1 int, n int, a int, b int, id string, fold int, path string, k int, start int, keeper long, size int, docs string"
    row = lambda i, t: (i, t, "en", "s", len(t or ""), 1, "x", 2, 3, 4, 5, "y", 6, "z", 7, 8, 9, 10, "w")
    docs = spark.createDataFrame([row(1, long), row(2, long), row(3, None), row(4, "short text")], schema)
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], ([1, 2, 3, 4], [1, 3, 4], [1, 3, 4], None), strict=True):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert expected is None or sorted(r.doc_id for r in rows) == expected, name
        assert all(r[5:] == row(0, "")[5:] for r in rows), name
        docs = spark.createDataFrame(rows, docs.schema)
    tokens = {r.doc_id: r.n_tokens for r in corpus_pipeline.token_ids(spark, docs, folder).collect()}
    assert tokens[1] > 700_000 and tokens[3] == 1
