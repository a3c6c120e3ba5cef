"""Operator 13: groups of words that differ by one edit.

Words are counted where they stand (partial aggregates), so only the vocabulary is
shuffled. Two words one inserted, deleted or replaced code point apart share all but
at most two of either's bigrams, each shared one whole before or whole behind the
edit. So among the three rarest bigrams of each word (by one global order, all places
of the third included) is one that both have, with the same letters up to it (the same
place from the left) or from it on (the same place from the right). The letters on
that side, the length and the side are the join's key, which is the position limit in
its sharpest form: words that only share a frequent bigram don't meet. Pairs of equal
lengths meet once, those a letter apart from the shorter word, and all are verified.
A word must have three bigrams for that, so at least four code points. The join has no bound on partners; Spark can split a frequent key, as both of its
sides are written tables.

Defined results: null texts have no words, a null id counts as an empty string in the
hash of ``damaged``; rows that repeat an id count each; ties of a word's forms go to
the smallest in code-point order; forms occur at least ``times`` as often as their
words, so following them ends; an empty table gives an empty result; of the columns
only those named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.llm._store import Scratch, light

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(run: Column) -> Column:
    """A-Z lower-cased; Spark's own function where a word is ASCII."""
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def damaged(run: Column, id_: Column, of: int = 199) -> Column:
    """``run`` without the code point at h modulo its length, if ``of`` divides h, the CRC-32 of id and run."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % of == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, of: int | None = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words of all texts; ``of`` None leaves them undamaged."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", lowered(F.col("run")).alias("run"))
    words = runs.select((damaged(F.col("run"), F.col("id"), of) if of else F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _rare(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``word``, ``length`` and place ``at`` (from 1) of its three rarest bigrams, all places of the third."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") > 1).select("word", F.explode(F.transform(places, lambda k: F.struct(k.alias("at"), F.substring(F.col("word"), k, F.lit(2)).alias("gram")))).alias("g")).select("word", "g.*")
    often, n = scratch.counted(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often")), "grams")
    order = Window.partitionBy("word").orderBy("often", "gram")
    return grams.join(light(often, n), "gram").withColumn("rank", F.rank().over(order)).where("rank <= 3").select("word", F.length("word").alias("length"), "at")


def near(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs ``a``, ``b`` of words exactly one edit apart, once each, with their counts ``n_a`` and ``n_b``."""
    rare = _rare(words.select("word"), scratch).join(words, "word")
    left, right = F.expr("substring(word, 1, at + 1)"), F.expr("substring(word, at)")
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("same")), F.struct(F.lit(1).alias("side"), right.alias("same"))))
    key = lambda length: F.xxhash64("side", "same", length)
    rows = scratch.keep(rare.select("word", "n", "length", sides.alias("s")).select("word", "n", "length", "s.*").distinct(), "places")
    short = rows.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("length").alias("length_a"), F.explode(F.array(key(F.col("length")), key(F.col("length") + 1))).alias("key"))
    long = rows.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("length").alias("length_b"), key(F.col("length")).alias("key"))
    once = (F.col("length_a") < F.col("length_b")) | (F.col("a") < F.col("b"))
    met = short.join(long, "key").where(once & (F.abs(F.col("length_b") - F.col("length_a")) <= 1) & (F.levenshtein("a", "b", 1) == 1))
    return scratch.keep(met.select("a", "b", "n_a", "n_b").distinct(), "pairs")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and its ``root``: the last of the chain of forms; chains halve each round."""
    step, n = scratch.counted(forms.select("word", F.col("form").alias("root")), "roots")
    while n:
        moved = Observation()
        up = light(step.select(F.col("word").alias("root"), F.col("root").alias("further")), n)
        new = step.join(up, "root", "left").observe(moved, F.count("further").alias("n"))
        new = scratch.keep(new.select("word", F.coalesce("further", "root").alias("root")), "roots")
        scratch.drop(step)
        step = new
        if not moved.get["n"]:
            break
    return step


def group(words: DataFrame, scratch: Scratch, times: int = 5) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each of ``words``, of four code points or more.

    A form is the near word of largest ``n``, if that is at least ``times`` the word's.
    """
    pairs = near(words, scratch)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best"))
    rows = words.join(best, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    rows = scratch.keep(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "formed")
    roots = _roots(rows.where("form is not null"), scratch)
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, times: int = 5, of: int | None = 199, **columns: str) -> DataFrame:
    """The vocabulary of ``docs`` with each word's form and root."""
    if min_length < 4:
        raise ValueError("words of fewer than four code points have fewer than three bigrams")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(vocabulary(docs, min_length, min_count, of, **columns), "words")
    return group(words, scratch, times)
