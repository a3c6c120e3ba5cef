"""The ten operators against brute force, planted cases and odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm import chunks, decontam, lines, mixing, neardup, quality, registry, simple8b, tokens, toxicity, urls, vectors
from folioforge.session import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, label string, path string, a int, rep int, spans string"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def docs_of(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", "z", 7, 8, "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefghijklmnop", k=chance.randint(2, 9))) for _ in range(n))


LONG = prose(1, 60_000)
ODD = [(1, None), (2, ""), (3, "one"), (3, "one"), (4, LONG), (5, "X" + LONG), (6, " \t\n\n "), (7, "one"), (8, "Ünïcode straße 東京 😀 " * 9), (None, "a text without an id " * 5), (9, "tie tie tie\n" * 40), (10, "tie tie tie\n" * 40, None)]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def least_reachable(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


# 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=400), st.data())
def test_simple8b_round_trip(ids, data):
    payload = simple8b.to_bytes(np.array(ids, np.uint64))
    assert simple8b.from_bytes(payload).tolist() == ids
    start = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(start, len(ids)))
    assert simple8b.span(payload, start, end).tolist() == ids[start:end]


def test_token_file_equals_the_tokenizer(spark, tmp_path):
    docs = [r for r in ODD if r[0] not in (3, None)] + [(20, "under_score's don't 12345 a b　c é")]
    table = docs_of(spark, docs)
    path = str(tmp_path / "ids")
    tokens.write_ids(table, path, WORDS)
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t, *_ in docs}
    assert {r.doc_id: r.ids for r in tokens.read_ids(spark, path).collect()} == expected
    at = 0
    found = {r.doc_id: r for r in tokens.encode(table, WORDS).collect()}
    for i in sorted(expected):
        ids = expected[i]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# 2


def test_quality_orders_grades(spark):
    chance = random.Random(3)
    kinds = ["spam cheap click offer winner", "some plain words about towns", "careful analysis theorem evidence method"]
    rows = [(i, " ".join(chance.choices(kinds[i % 3].split(), k=30))) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 3) for i in range(600)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.grade(docs_of(spark, rows), labels).collect()}
    mean = [np.mean([out[i].expected_grade for i in range(600) if i % 3 == g and out[i].held_out]) for g in range(3)]
    assert mean[0] < 0.5 < 0.8 < mean[1] < 1.2 < 1.5 < mean[2]
    assert {i for i in out if out[i].selected} == {i for i in range(600) if i % 3}


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = registry.op2_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out and quality is not null")
    assert out.agg(F.avg((F.col("selected").cast("int") == F.col("quality")).cast("int"))).first()[0] > 0.85


# 3


def test_decontamination_finds_planted_passages(spark):
    items = [prose(100 + i, 12 + 5 * i) for i in range(8)] + ["two words", "", None]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, id string")
    rows = [(i, f"{prose(i, 300)} {items[i]} {prose(50 + i, 300)}") for i in range(8)]
    rows += [(20 + i, prose(200 + i, 400)) for i in range(8)] + [(40, items[7].upper())]
    docs = docs_of(spark, rows + [(41, None), (42, "")])
    found = {(r.doc_id, r.item_id) for r in decontam.matches(docs, benchmark).collect()}
    assert found >= {(i, i) for i in range(8)} | {(40, 7)}
    assert all(d < 20 or d == 40 for d, _ in found)
    left = decontam.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {*range(20, 28), 41, 42}


def test_decontamination_finds_truncated_items_as_whole_documents(spark):
    items = [prose(300 + i, 60) for i in range(20)] + [prose(330, 12), "one two three four"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(100 * cut + i, " ".join(t.split()[: len(t.split()) - cut])) for cut in (1, 3, 9, 11, 12, 30) for i, t in enumerate(items)]
    rows += [(1000 + i, " ".join(t.split()[3:])) for i, t in enumerate(items)]

    def near(text, item):
        a, b = (words(t) for t in (text, item))
        a, b = (Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in (a, b))
        return bool(a) and 10 * (a & b).total() >= 8 * (a | b).total()

    expected = {(d, i) for d, t in rows for i, item in enumerate(items) if near(t, item)}
    assert len(expected) == 101
    out = decontam.matches(docs_of(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in out} == expected
    assert all(r.first_word == 0 and r.n_words == len(dict(rows)[r.doc_id].split()) for r in out)
    assert {r.doc_id for r in decontam.drop_contaminated(docs_of(spark, rows), benchmark).collect()} == {d for d, _ in rows} - {d for d, _ in expected}


# 4


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    base = prose(7, 120).split()
    chance = random.Random(8)
    rows = [(i, prose(i, 40)) for i in range(40)]
    for i in range(40, 100):
        near = list(base)
        for _ in range(chance.randint(0, 4)):
            near[chance.randrange(len(near))] = chance.choice("uvwxyz")
        rows.append((i, " ".join(near)))
    rows += [r for r in ODD if r[0] is not None]
    rows = [(i + 1000 * (n >= 100), t) for n, (i, t, *_) in enumerate(rows)]
    out = neardup.components_of(docs_of(spark, rows), k=k).collect()
    sets = [shingle_set(t, k) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    component = least_reachable({i for i, _ in rows}, links)
    expected = sorted((i, len(s), component[i], component[i] == i) for (i, _), s in zip(rows, sets, strict=True))
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == expected


def test_near_duplicates_keep_their_recall_in_deep_nodes():
    chance = np.random.default_rng(4)
    pairs, agree = 400, 48
    tokens_of = chance.integers(0, 1 << 32, (2 * pairs, 64), dtype=np.uint32)
    for i in range(pairs):
        places = chance.permutation(64)[:agree]
        tokens_of[2 * i + 1, places] = tokens_of[2 * i, places]
    stored = pa.array([t.tobytes() for t in tokens_of], pa.binary())
    entries = pa.Table.from_batches(neardup._entries(4)([pa.RecordBatch.from_arrays([pa.array(range(2 * pairs)), pa.array([9] * 2 * pairs), stored], names=["rep", "n", "tokens"])]))
    for _ in range(6):
        rows = sorted(set(zip(entries["path"].to_pylist(), entries["rep"].to_pylist(), strict=True)))
        holders = {}
        for path, rep in rows:
            holders.setdefault((path, rep // 2), []).append(rep)
        shared = [(path, rep) for (path, _), reps in holders.items() if len(reps) == 2 for rep in reps]
        path, rep = (pa.array(c, pa.int64()) for c in zip(*shared, strict=True))
        entries = pa.Table.from_batches(neardup._branch([pa.RecordBatch.from_arrays([path, rep, rep, stored.take(rep)], names=["path", "rep", "n", "tokens"])]))
    # Pairs still together; with 48 of 64 places about 1 in 8,000 is expected to be lost, with 1.25 children 1 in 34.
    assert len({rep // 2 for _, rep in shared}) >= pairs - 1


# 5


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = registry.op5_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("toxic is not null").toPandas()
    assert out.score.between(0, 1).all() and ((out.score >= 0.5).astype(int) == out.predicted).all()
    assert out.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]
    held = out[out.held_out]
    assert (held.predicted == held.toxic).mean() > 0.85


# 6


def test_near_vectors_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    out = {r.vec_id: r for r in registry.op6_near_vectors(spark, folder).collect()}
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in table], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    ids = [r.vec_id for r in table]
    true = dict(zip(ids, near.sum(1).tolist(), strict=True))
    assert all(out[i].n_links <= true[i] for i in ids)
    assert sum(out[i].n_links for i in ids) >= 0.95 * sum(true.values())


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0, 8.0]), (3, None), (4, [0.0] * 4), (5, [1.0, None, 3.0, 4.0]), (6, [float("nan"), 2.0, 3.0, 4.0]), (7, [-1.0, 2.0, -3.0, 4.0]), (8, []), (9, v), (9, v)]
    out = vectors.links_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 10
    assert {r.vec_id: r.component_id for r in out} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 1}
    assert {r.vec_id for r in out if r.n_links} == {1, 2, 9}


# 7


@pytest.mark.parametrize(("name", "sql"), registry.oracle_sql().items())
def test_sql_of_the_queries(spark, sf_dir, name, sql):
    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = registry.queries()[name](spark, sf_dir)
    result = connection.execute(f"SELECT {', '.join(frame.columns)} FROM ({sql})").fetchall()
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, result))


def test_mixing_comes_near_its_targets(spark):
    rows = [(i, prose(i, 5 + i % 7), "abcd"[min(3, i % 9)]) for i in range(900)] + [(1000, None, None), (1001, "x y", None)]
    docs = docs_of(spark, rows)
    plan = mixing.plan(docs, buckets=16).toPandas()
    for _, part in plan.groupby("_mix_target"):
        assert abs(part._mix_taken.sum() - part._mix_target.iloc[0] * part.source.fillna("").nunique()) <= 2 * part._mix_size.max()
    assert (plan._mix_taken <= 2 * plan._mix_size).all()
    mixed = mixing.apply(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == plan._mix_taken.sum()


# 8


def test_repeated_passages_survive_shifts(spark):
    passage = prose(500, 80)
    rows = [(i, f"{prose(600 + i, 100 + 13 * i)} {passage} {prose(700 + i, 90)}") for i in range(6)] + [(50 + i, prose(800 + i, 300)) for i in range(6)]
    docs = docs_of(spark, rows + [(60, None), (61, "")])
    found = chunks.repeats(docs).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5}
    texts = dict(rows)
    for r in found:
        assert texts[r.doc_id].encode()[r.start : r.end].decode().strip() in passage
    left = {r.doc_id: r.text for r in chunks.drop_repeats(docs).collect()}
    assert left[0] == texts[0] and left[50] == texts[50] and left[60] is None
    assert all(len(left[i].split()) < len(texts[i].split()) - 50 for i in range(1, 6))


# 9


def test_repeated_lines_equal_brute_force(spark):
    rows = [(i, t) for i, t, *_ in ODD if i not in (3, None)] + [(11, "A shared line here\nown of eleven\r\n"), (12, "  a SHARED line here\t\nown of twelve"), (13, "short\nshort"), (14, "tie tie tie"), (15, "twice in one\ntwice in one")]
    keys, holders = {}, {}
    for i, t in rows:
        keys[i] = [line.strip(" \t\n\x0b\x0c\r") for line in (t or "").split("\n")]
        keys[i] = [re.sub("[A-Z]", lambda m: m[0].lower(), k) for k in keys[i]]
        for k in keys[i]:
            holders.setdefault(k, set()).add(i)
    expected = []
    for i, t in rows:
        parts = (t or "").split("\n")
        lost = [len(k) >= 10 and len(holders[k]) >= 2 and min(holders[k]) != i for k in keys[i]]
        kept = "\n".join(p for p, x in zip(parts, lost, strict=True) if not x)
        expected.append((i, len(parts), sum(lost), hashlib.sha256(kept.encode()).hexdigest()))
    out = lines.drop_repeated(docs_of(spark, rows)).select("doc_id", "_line_count", "_line_dropped", F.sha2("_line_text", 256)).collect()
    assert sorted(map(tuple, out)) == sorted(expected)


# 10


def test_url_rules_and_propagation(spark):
    link = '<a href="{}">x</a>'.format
    rows = [
        (1, "http://example.com/en/1", None, ("com/en/", "block")),
        (2, "https://EXAMPLE.com/en/7?q", None, ("example.com/en/7", "allow")),
        (3, "http://a.example.net/de/8", None, ("example.net/de/8", "block")),
        (4, "http://example.net/de/9#x", None, ("net/de/", "allow")),
        (5, "http://x.org/es/", link("http://far.test/"), ("org/es/", "block")),
        (6, "no scheme", None, (None, "allow")),
        (7, None, None, (None, "allow")),
        (8, "http://bad.test/", link("http://x.org/es/") * 3, (None, "block")),
        (9, "http://good.test/", "", (None, "allow")),
        (10, "http://xcom/en/", "", (None, "allow")),
    ]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    out = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert out == {r[0]: r[3] for r in rows}


def test_url_propagation_reaches_far_hosts_and_small_shares(spark):
    link = '<a href="http://{}.test/">x</a>'.format
    rows = [(1, "http://x.org/es/", None), (2, "http://far0.test/", '<a href="http://x.org/">x</a>'), (3, "http://small0.test/", '<a href="http://x.org/">x</a>')]
    rows += [(100 + i, f"http://far{i}.test/", link(f"far{i - 1}")) for i in range(1, 26)]
    rows += [(200 + i, f"http://small{i}.test/", link(f"small{i - 1}")) for i in range(1, 5)]
    rows += [(300 + i, f"http://filler{i}.test/", link(f"small{i}") * 5000) for i in range(4)]
    out = urls.judge(spark.createDataFrame([*rows, (400, "http://apart.test/", "")], "page_id long, url string, html string")).collect()
    assert {r.page_id for r in out if r.verdict == "allow"} == {400}
    assert all(r.distrust > 0 for r in out if r.page_id != 400)


# all


def operators(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 11)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, prose(9, 30))], "item_id long, text string")
    return {
        "tokens": lambda d: tokens.encode(d, WORDS),
        "quality": lambda d: quality.grade(d, labels),
        "selected": lambda d: quality.select(d, labels),
        "decontamination": lambda d: decontam.drop_contaminated(d, benchmark),
        "near": neardup.components_of,
        "near_dropped": neardup.drop_duplicates,
        "toxicity": lambda d: toxicity.scores(d, labels),
        "mixing": mixing.plan,
        "mixed": mixing.apply,
        "passages": chunks.drop_repeats,
        "lines": lines.drop_repeated,
    }


ONE_ROW_EACH = {"tokens", "quality", "near", "toxicity", "mixing", "passages", "lines", "decontamination"}


@pytest.mark.parametrize("name", ["tokens", "quality", "selected", "decontamination", "near", "near_dropped", "toxicity", "mixing", "mixed", "passages", "lines"])
def test_odd_and_empty_tables(spark, name):
    operator = operators(spark)[name]
    n = len(operator(docs_of(spark, ODD)).collect())
    assert n == len(ODD) if name in ONE_ROW_EACH else n <= 2 * len(ODD)
    assert operator(docs_of(spark, ODD).where("false")).collect() == []


def test_empty_pages_and_vectors(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    assert vectors.links_of(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
