"""Operators 11 to 13 against the library and brute force, on prose and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import public_tokenizers
import pytest

from folioforge.llm import audit, spelling, token_counts
from folioforge.llm._store import Scratch
from folioforge.session import ship

FILES = ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"]
SCHEMA = "doc_id long, text string, lang string, word string, n long, A int, id string, good int"
ODD = ["a", "b", "the", " ", " ", "  ", "\n", "\r\n", "\t", "▁", "é", "É", "́", "中", "　", "\xa0", "<s>", "</s>", "<|endoftext|>", "\x00", "\x85", ".", "'s", "1", "\U0001f600", "Σ"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", 1, 1, "x", 1) for i, t, lang in rows], SCHEMA)


def odd_texts(seed, n, longest=30):
    chance = random.Random(seed)
    return ["".join(chance.choices(ODD, k=chance.randint(0, longest))) for _ in range(n)]


def library_count(path):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


# token counts


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("window, long", [(1 << 22, 1 << 16), (48, 16)])
def test_counts_are_the_librarys(monkeypatch, name, window, long):
    monkeypatch.setattr(token_counts, "WINDOW", window)
    monkeypatch.setattr(token_counts, "LONG", long)
    path = public_tokenizers.path(name)
    counts, count = token_counts.Counts(path), library_count(path)
    assert counts.counter.cuts
    texts = odd_texts(1, 3000) + ["".join(random.Random(k).choices("中文字axé▁th", k=150)) for k in range(50)] + ["ab" * 200, " " * 300, "\n" * 300, "▁" * 300]
    assert counts.of(pa.array(texts)).tolist() == [count(t) for t in texts]
    assert counts.of(pa.array([None, "", None], pa.string())).tolist() == [0, 0, 0]
    assert counts.of(pa.array([], pa.string())).tolist() == []


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    path = public_tokenizers.path(FILES[0])
    counts, count = token_counts.Counts(path), library_count(path)
    for seed in range(3):
        texts = odd_texts(seed, 200)
        assert counts.of(pa.array(texts)).tolist() == [count(t) for t in texts]


def test_token_counts_of_odd_rows(spark):
    long = " ".join(odd_texts(7, 1)[0] + str(k) for k in range(300_000))
    rows = [(1, None, "en"), (2, "", None), (3, "two words", "en"), (3, "two words", "en"), (None, "no id é", "en"), (4, long, "de")]
    docs = docs_of(spark, rows)
    out = token_counts.count_tokens(docs, public_tokenizers.path(FILES[0]), limit=2)
    assert out.columns == [*docs.columns, "_token_bytes", "_token_count", "_token_over"]
    count = library_count(public_tokenizers.path(FILES[0]))
    expected = sorted((i or 0, len((t or "").encode()), count(t or ""), count(t or "") > 2) for i, t, _ in rows)
    assert sorted((r.doc_id or 0, r._token_bytes, r._token_count, r._token_over) for r in out.collect()) == expected
    assert token_counts.count_tokens(docs_of(spark, []), public_tokenizers.path(FILES[0])).count() == 0


# filter audit


def brute_audit(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > least[text]}
        parts[lang or ""].append((fails, i in good, i in toxic))
    out = set()
    for part, rows in parts.items():
        steps, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for k, f in enumerate(order):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                total[f] += len(gone)
                failing = [r for r in rows if r[0][f]]
                alone = sum(sum(r[0].values()) == 1 for r in failing)
                steps.append((part, order, k + 1, len(left), len(gone), len(failing) - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out |= {(*s[:-1], total[s[-1]]) for s in steps}
    return out


def audit_rows(seed, n):
    chance = random.Random(seed)
    rows = []
    for k in range(n):
        words = chance.choices(["one", "two", "three", "Été", "LOUD", "a", "#tag", "50%"] + [f"w{j}" for j in range(chance.choice([5, 400]))], k=chance.choice([0, 3, 199, 200, 201, 450]))
        rows.append((k, chance.choice([" ", "\n", "\t "]).join(words), chance.choice(["en", "de", "", None])))
    rows += [(chance.randrange(n, 2 * n), rows[chance.randrange(n)][1], chance.choice(["en", "fr"])) for _ in range(n // 2)]
    return rows + [(None, rows[3][1], "en"), (None, None, None), (3, rows[3][1], "de"), (7, None, "en"), (8, "", "en")]


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_filter_audit(spark, monkeypatch, piece):
    monkeypatch.setattr(audit, "PIECE", piece)
    for docs in ([], audit_rows(2, 60)):
        labels = [(i, (i or 0) % 2, (i or 0) % 3 == 0) for i, _, _ in docs[::2]] + [(1, 0, 1), (1, 1, None), (None, 1, 1)]
        known = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
        got = {tuple(r) for r in audit.audit_documents(docs_of(spark, docs), known).collect()}
        assert got == brute_audit(docs, labels)


def test_measures_do_not_depend_on_pieces(monkeypatch):
    texts = [*odd_texts(5, 200, 200), "", "x" * 500, " ".join(f"w{k % 70}" for k in range(900))]
    column = pa.array([*texts, None])
    expected = []
    for t in [*texts, ""]:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        expected.append([len(words), len(set(words)), len(t), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t))])
    for piece in (1 << 20, 512, 16):
        monkeypatch.setattr(audit, "PIECE", piece)
        assert [list(x) for x in zip(*[m.tolist() for m in audit._measured(column)], strict=True)] == expected


def test_filter_audit_of_a_text_of_several_megabytes(spark):
    text = " ".join(str(k % 90_000) for k in range(700_000)) + " END"
    rows = [(1, text, "en"), (2, text, "en")]
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in audit.audit_documents(docs_of(spark, rows), known).collect()} == brute_audit(rows, [])


# spelling


def edits(word, letters):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in letters)


def brute_words(docs, of=199):
    found = Counter()
    for i, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % of == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute_groups(counts, times=5):
    letters = sorted(set("".join(counts)))
    forms, out = {}, set()
    near = {w: {x for x in edits(w, letters) if x in counts and x != w} for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= times * n else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, n, len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root))
    return out


def test_spelling_of_prose(spark):
    chance = random.Random(3)
    stems = ["".join(chance.choices("abcdeéÀ×", k=chance.randint(5, 12))) for _ in range(150)]
    rows = [(k, " ".join(chance.choice([w, w.upper(), w.capitalize()]) for w in chance.choices(stems, k=400)), "en") for k in range(150)]
    rows += [(None, " ".join(stems * 6), "en"), (3, None, "en"), (4, "", "en"), (5, "12 34 ab", "en")]
    counts = brute_words(rows)
    assert any(w not in stems for w in counts) and len(counts) > 100
    assert {tuple(r) for r in spelling.variants(docs_of(spark, rows)).select("word", "n", "n_near", "form", "form_n", "root").collect()} == brute_groups(counts)
    assert {tuple(r) for r in spelling.vocabulary(docs_of(spark, rows), of=None).collect()} == {(w, n) for w, n in brute_words(rows, of=1 << 40).items()}


@pytest.mark.parametrize("seed, letters, shortest, longest", [(1, "ab", 6, 9), (2, "abc", 4, 6), (3, "abé×", 6, 30), (4, "aab", 6, 7)])
def test_near_words_are_all_found(spark, seed, letters, shortest, longest):
    """Few letters make frequent, repeated and overlapping bigrams; runs of one letter many equal ones."""
    chance = random.Random(seed)
    counts = {"".join(chance.choices(letters, k=chance.randint(shortest, longest))): chance.choice([5, 7, 24, 25, 26, 130, 700]) for _ in range(400)}
    for w in list(counts)[:150]:
        counts.setdefault(chance.choice([x for x in edits(w, letters) if shortest <= len(x)]), chance.choice([5, 25, 125]))
    counts |= {"a" * k: 5 ** (k % 5 + 1) for k in range(shortest, longest)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in spelling.group(words, Scratch(spark, "near")).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == brute_groups(counts)


def test_spelling_of_empty_tables(spark):
    assert spelling.variants(docs_of(spark, [])).count() == 0
    assert spelling.variants(docs_of(spark, [(1, "singular", "en")])).count() == 0
    with pytest.raises(ValueError, match="four"):
        spelling.variants(docs_of(spark, []), min_length=3)
