"""tex_to_plain against a scanner that reads character by character, and against words written by hand."""

import hashlib
import random

from folioforge.functions.text import SHOWN, tex_to_plain
from folioforge.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.01"
LETTERS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ@")
BY_HAND = {
    r"\textbf{Lead} \emph{in} $x_1$ & more": "Lead in x 1 more",
    r"a\textbf{b}c": "abc",
    r"a\textbf {b {c}}d": "a b c d",
    r"\underline{\emph{deep}}": "deep",
    r"\section*{One} \\ two": "One two",
    "x\\SA{}y\n\t z ~": "x y z",
    r"cut \multicolumn{2}{c|}{wide cell} ": "cut wide cell",
    "": "",
    "plain": "plain",
    r"\unknown": "",
    r"}{": "",
}


def shown(text):
    """Arguments without braces of macros that show them, glued to what stands around."""
    out, k = [], 0
    while k < len(text):
        for name in SHOWN:
            if text.startswith("\\" + name, k):
                at = k + 1 + len(name)
                while at < len(text) and text[at].isspace():
                    at += 1
                end = at + 1
                while end < len(text) and text[end] not in "{}":
                    end += 1
                if at < len(text) and text[at] == "{" and end < len(text) and text[end] == "}":
                    out.append(text[at + 1 : end])
                    k = end + 1
                    break
        else:
            out.append(text[k])
            k += 1
    return "".join(out)


def plain(text):
    """Without the rule of the last cell, which the texts here don't have."""
    text, out, k = shown(text.replace("\\SA{}", " ")), [], 0
    while k < len(text):
        if text[k] == "\\" and text[k + 1 : k + 2] in LETTERS and k + 1 < len(text):
            k += 1
            while k < len(text) and text[k] in LETTERS:
                k += 1
            k += text[k : k + 1] == "*"
            out.append(" ")
        else:
            out.append(" " if text[k] in "{}$&#_^~\\" else text[k])
            k += 1
    return " ".join("".join(out).split())


def test_by_hand_and_by_scanner(spark):
    chance = random.Random(11)
    words = [r"\textbf", r"\emph", r"\mbox*", "{", "}", "{", "}", "a", "b c", " ", "\n", "\\", "$x$", "&", r"\SA{}", r"\par", "é"]
    made = ["".join(chance.choices(words, k=chance.randint(0, 25))) for _ in range(2000)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*BY_HAND, *made])], "id long, text string")
    got = [r.p for r in rows.select("id", tex_to_plain(rows.text).alias("p")).orderBy("id").collect()]
    assert got[: len(BY_HAND)] == list(BY_HAND.values())
    assert got[len(BY_HAND) :] == [plain(t) for t in made]


def test_every_document_and_its_whole_text(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    expected = {i: (None, None) if t is None else (len(plain(t)), hashlib.md5(plain(t).encode()).hexdigest()) for i, t in texts.items()}
    assert {r.doc_id: (r.chars, r.plain_md5) for r in QUERIES["plain_texts"][0](spark, FOLDER).collect()} == expected
