"""Operator 12: how filters overlap, whatever their order.

Each document gets one flag a filter (true: it fails). Per part, the documents that
fail all filters of a set are counted for each of the 2^n sets, as a sum of products
of flags: partial aggregates of fixed width, so neither a part nor a group of copies
meets in one task. All other figures follow from these counts J:

* survivors of a set S, by Moebius inversion: sum over T within S of (-1)^|T| J(T);
  a filter removes, after a prefix S, survivors(S) - survivors(S and it);
* documents that fail one filter f only: sum over T with f of (-1)^(|T|-1) J(T);
* the Harsanyi dividend of T in the game "removed by S" is (-1)^(|T|+1) J(T), and a
  filter's Shapley value the sum of dividends of its sets, each shared equally; times
  n! it is the sum of what the filter removes over all orders.

Texts are read once, by an Arrow function for the counts of words and characters and
by Spark's SHA-256 for equality; only ids, parts, flags and digests go further.
A long text is counted by pieces, whose different words are kept as 64-bit hashes.

Defined results: a null text is empty; a document is a copy if a smaller id, in any
part, has the same text, so rows that share the smallest id are no copies, and rows
without an id neither are copies nor make any; rows that repeat an id count each; an
id with several labels is good, or toxic, if one of them says so; unlabelled ones are
neither; a null part is the empty string; an empty table gives an empty result; of
the columns only those named are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioforge.llm._store import Scratch
from folioforge.llm._text import PIECE, SPACE, buffer_of, give_back, hash_ranges

#: Characters of markup and code, each of which makes a document fail D.
SYMBOLS = b"#$%&*|"
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_MEASURES = ("words", "distinct", "chars", "upper", "symbols")


def _words(data: np.ndarray) -> tuple[int, int]:
    """Words, and different words, of one text of any length; a piece ends before a space or, in a longer word, after it."""
    total, seen = 0, np.zeros(0, np.uint64)
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and not SPACE[data[end]]:
            end += 1
        solid = ~SPACE[data[at:end]]
        edges = np.diff(np.r_[False, solid, False].astype(np.int8))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        total += len(first)
        seen = np.union1d(seen, hash_ranges(data[at:end], first, last)) if len(seen) else np.unique(hash_ranges(data[at:end], first, last))
        at = end
    return total, len(seen)


def _measured(column: pa.Array) -> list[np.ndarray]:
    """``_MEASURES`` of each text; short texts together, a long one by pieces."""
    data, offsets = buffer_of(column)
    n = len(offsets) - 1
    out = [np.zeros(n, np.int64) for _ in _MEASURES]
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        part, edges = data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        for k, mask in ((2, (part & 0xC0) != 0x80), (3, _UPPER[part]), (4, _SYMBOL[part])):
            out[k][at:end] = np.diff(np.r_[0, np.cumsum(mask)][edges])
        if end == at + 1:
            out[0][at], out[1][at] = _words(part)
        else:
            gap = np.ones(len(part) + 1, bool)
            gap[:-1] = SPACE[part]
            begins = ~gap[:-1]
            begins[1:] &= gap[:-2] | np.isin(np.arange(1, len(part)), edges)
            ends = ~gap[:-1] & (gap[1:] | np.isin(np.arange(1, len(part) + 1), edges))
            first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            row = np.searchsorted(edges, first, "right") - 1
            value = hash_ranges(part, first, last)
            order = np.lexsort((value, row))
            value, sorted_row = value[order], row[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (sorted_row[1:] != sorted_row[:-1])
            out[0][at:end] = np.bincount(row, minlength=end - at)
            out[1][at:end] = np.bincount(sorted_row[new], minlength=end - at)
        at = end
    return out


@F.arrow_udf(StructType([StructField(name, LongType()) for name in _MEASURES]))
def measures(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        yield pa.StructArray.from_arrays([pa.array(x) for x in _measured(column)], names=list(_MEASURES))
    give_back()


def flags(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """``part``, the flags ``A`` to ``E``, ``good`` and ``toxic`` of each document.

    A: under 200 words. B: fewer different words than half of them. C: more than 3 % capitals A-Z.
    D: holds one of ``SYMBOLS``. E: a copy of a document with a smaller id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), measures(text).alias("m"))
    m = F.col("m")
    failed = {"A": m["words"] < 200, "B": 100 * m["distinct"] < 50 * m["words"], "C": 100 * m["upper"] > 3 * m["chars"], "D": m["symbols"] > 0}
    rows = scratch.keep(rows.select("id", "part", F.unhex("digest").alias("digest"), *[c.alias(x) for x, c in failed.items()]), "flags")
    # Written, so that Spark can split what meets a text that a third of all documents share.
    copied = scratch.keep(rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("other")).where("least <> other").select("digest", "least"), "copied")
    known = labels.select(F.col(id_col).alias("id"), F.col(good_col).alias("q"), F.col(toxic_col).alias("t")).where("id is not null")
    known = known.groupBy("id").agg(F.max(F.coalesce(F.col("q") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("t") == 1, F.lit(False))).alias("toxic"))
    known = scratch.keep(known.where("good or toxic"), "known")
    rows = rows.join(copied, "digest", "left").select("id", "part", *failed, F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E"))
    return rows.join(known, "id", "left").select("part", *failed, "E", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def joint_failures(flagged: DataFrame, filters: Sequence[str], weights: dict[str, Column], part_col: str = "part") -> DataFrame:
    """Per part, for each of ``weights`` an array over all sets of filters (bit k: filter k) of the weight of rows that fail them all."""
    sets = range(1 << len(filters))
    one = {f: F.col(f).cast("long") for f in filters}
    product = lambda s, w: reduce(lambda a, b: a * b, [one[f] for k, f in enumerate(filters) if s >> k & 1], w)
    sums = flagged.groupBy(part_col).agg(*[F.sum(product(s, w)).alias(f"{name}_{s}") for name, w in weights.items() for s in sets])
    return sums.select(F.col(part_col).alias("part"), *[F.array(*[F.col(f"{name}_{s}") for s in sets]).alias(name) for name in weights])


def _survivors(joint: Column, n: int) -> Column:
    within = lambda s: [t for t in range(1 << n) if t & s == t]
    return F.array(*[_sum([(-1) ** t.bit_count() * F.get(joint, F.lit(t)) for t in within(s)]) for s in range(1 << n)])


def audit(flagged: DataFrame, filters: Sequence[str] = "ABCDE", part_col: str = "part", good_col: str = "good", toxic_col: str = "toxic") -> DataFrame:
    """One row a part, order of the filters and step of it, from boolean columns ``filters`` named by one letter each."""
    n = len(filters)
    weights = {"all": F.lit(1).cast("long"), "good": F.col(good_col).cast("long"), "toxic": F.col(toxic_col).cast("long")}
    joint = joint_failures(flagged, filters, weights, part_col)
    all_ = F.col("all")
    with_ = lambda k: [t for t in range(1 << n) if t >> k & 1]
    unique = F.array(*[_sum([(-1) ** (t.bit_count() - 1) * F.get(all_, F.lit(t)) for t in with_(k)]) for k in range(n)])
    shapley = F.array(*[_sum([(-1) ** (t.bit_count() + 1) * (factorial(n) // t.bit_count()) * F.get(all_, F.lit(t)) for t in with_(k)]) for k in range(n)])
    left = joint.select("part", *[_survivors(F.col(w), n).alias(f"left_{w}") for w in weights], F.array(*[F.get(all_, F.lit(1 << k)) for k in range(n)]).alias("failing"), unique.alias("unique"), shapley.alias("shapley"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    rows = left.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    bits = lambda letters: _sum([F.when(F.contains(letters, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(filters)])
    rows = rows.withColumn("before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))).withColumn("after", bits(F.substring("filter_order", F.lit(1), F.col("step"))))
    rows = rows.withColumn("at", F.locate("1", F.reverse(F.bin(F.col("after") - F.col("before")))) - 1)
    lost = {w: F.get(f"left_{w}", F.col("before")) - F.get(f"left_{w}", F.col("after")) for w in weights}
    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int"),
        F.get("left_all", F.col("after")).alias("kept"),
        lost["all"].alias("removed"),
        (F.get("failing", F.col("at")) - lost["all"]).alias("redundant"),
        F.get("unique", F.col("at")).alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        F.get("shapley", F.col("at")).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``audit`` of the five filters of ``flags``."""
    return audit(flags(docs, labels, Scratch(docs.sparkSession, "audit"), **columns))
