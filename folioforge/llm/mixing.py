"""Operator 7: mix sources to target weights.

A document's key is the MD5 of its id and text, so any prefix of the keys' order is a
random sample of its source, whatever ids repeat or lack. Keys are range-partitioned
into equal ranges, one for every ``BUCKET_ROWS`` documents: bucket sums (partial
aggregates) give each bucket its offset in its source, and a running sum inside a
bucket does the rest, so no source, however large, is sorted in one task (the few rows
of sources and of their buckets meet in windows without a partition or by source; only
rows alike in source, id and text share a key). A source whose target is below its size is cut at
the word that fills it; one above is repeated whole, then cut.

Only DataFrame operations run. Defined results: a null text has size 0; a null
source is a source of its own, ordered last; a null id counts as an empty one in the
key; rows that share an id are separate documents, with keys of their own if their
texts differ; an empty table or sources without words give targets of 0 and take nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents of a range of keys, over all sources.
BUCKET_ROWS = 8192
WORD = r"[^\x20\x09-\x0D]+"
_SOURCE = ["_mix_source", "_mix_none"]


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Adds ``_mix_target`` to one row a source with ``_mix_total``.

    Sharing the excess of capped sources by weight until none is above its cap has
    one outcome: a level L with target = min(cap, L * weight). Sources are ordered by
    the level at which they reach their cap; the first that stays below gives L.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("_mix_none", "_mix_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_mix_weight", weight).withColumn("_mix_cap", F.col("_mix_total") * F.lit(float(cap)))
    rows = rows.withColumn("_mix_budget", F.sum("_mix_total").over(everything) * F.lit(float(share))).withColumn("_mix_full", F.col("_mix_cap") / F.col("_mix_weight"))
    by_level = Window.orderBy("_mix_full", *_SOURCE[::-1])
    before = F.coalesce(F.sum("_mix_cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("_mix_weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("_mix_level", (F.col("_mix_budget") - before) / onward).withColumn("_mix_rank", F.row_number().over(by_level))
    found = F.min(F.when(F.col("_mix_level") <= F.col("_mix_full"), F.struct("_mix_rank", "_mix_level"))).over(everything)
    level = F.coalesce(found["_mix_level"], F.max("_mix_full").over(everything))
    return rows.withColumn("_mix_target", F.least("_mix_cap", level * F.col("_mix_weight"))).select(*_SOURCE, "_mix_total", "_mix_target")


def plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_total`` (of its source), ``_mix_target`` and ``_mix_taken``.

    ``buckets`` of the keys, if given, changes no result.
    """
    buckets = buckets or 64 + docs.count() // BUCKET_ROWS
    name, source = F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(source_col)
    rows = (
        docs.withColumn("_mix_size", F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long"))
        .withColumn("_mix_key", F.md5(F.concat(name, F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))))
        .withColumn("_mix_source", F.coalesce(source.cast("string"), F.lit("")))
        .withColumn("_mix_none", source.isNull())
        .withColumn("_mix_bucket", (F.conv(F.substring("_mix_key", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32)).cast("int"))
    )
    part = [*_SOURCE, "_mix_bucket"]
    sums = rows.groupBy(*part).agg(F.sum("_mix_size").alias("_mix_sum"))
    sizes = sums.groupBy(*_SOURCE).agg(F.sum("_mix_sum").alias("_mix_total"))
    order = Window.partitionBy(*_SOURCE).orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_mix_offset", F.coalesce(F.sum("_mix_sum").over(order), F.lit(0))).join(targets(sizes, weights, share, cap), _SOURCE).drop("_mix_sum")
    rows = rows.join(offsets, part)
    inside = Window.partitionBy(*part).orderBy("_mix_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_mix_offset") + F.sum("_mix_size").over(inside) - F.col("_mix_size")
    total = F.col("_mix_total")
    whole = F.when(total > 0, F.floor(F.col("_mix_target") / total)).otherwise(0).cast("long")
    rest = F.floor("_mix_target") - whole * total
    taken = whole * F.col("_mix_size") + F.greatest(F.lit(0), F.least(F.col("_mix_size"), rest - before))
    return rows.withColumn("_mix_taken", taken.cast("long")).select(*docs.columns, "_mix_size", "_mix_total", "_mix_target", "_mix_taken")


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), n.cast("int")), "")


def apply(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **settings) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: whole repeats of each document, and the cut one up to the word that fills the target.

    Documents without words take no budget and stay once.
    """
    rows = plan(docs, text_col=text_col, **settings)
    size, taken = F.col("_mix_size"), F.col("_mix_taken")
    copies = F.when(size > 0, F.ceil(taken / F.when(size > 0, size))).otherwise(1).cast("int")
    rows = rows.withColumn("_mix_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    left = taken - (F.col("_mix_copy") - 1) * size
    cut = (size > 0) & (left < size)
    rows = rows.withColumn(text_col, F.when(cut, first_words(F.col(text_col), left)).otherwise(F.col(text_col)))
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        rows = rows.withColumn(length_col, F.when(cut, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return rows.select(*docs.columns)
