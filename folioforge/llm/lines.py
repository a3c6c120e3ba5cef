"""Operator 9: drop lines that other documents hold too.

Lines are exploded with their positions, normalised and hashed to 128 bits; per hash
the least and the greatest ``doc_id`` are partial aggregates that tell whether at
least two documents hold it and which keeps it, so a line shared by a third of all
documents costs one row a task. These are written, so that Spark can split what
meets a frequent line. A text then meets the list of its dropped positions, and is
put together from the positions that stay.

Defined results: a null or empty text is one empty line; rows that share an id are
one document, each losing its lines that an earlier document holds; rows without an
id neither count nor lose lines; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm._store import Scratch

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def drop_repeated(docs: DataFrame, min_length: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_line_count``, ``_line_dropped`` and ``_line_text``, the text that stays."""
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    same_text = F.xxhash64(text_col)
    lines = docs.select(F.col(id_col).alias("id"), same_text.alias("of"), F.posexplode(parts).alias("at", "line")).select("id", "of", "at", key_of(F.col("line")).alias("key")).where(F.length("key") >= min_length)
    lines = lines.select("id", "of", "at", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    shared = lines.groupBy("a", "b").agg(F.min("id").alias("keeper"), F.max("id").alias("other")).where("keeper <> other").select("a", "b", "keeper")
    shared = Scratch(docs.sparkSession, "lines").keep(shared, "shared")
    lost = lines.join(shared, ["a", "b"]).where("id <> keeper").groupBy(F.col("id").alias("_line_id"), F.col("of").alias("_line_of")).agg(F.collect_list("at").alias("_line_lost"))
    rows = docs.join(lost, (docs[id_col] == lost["_line_id"]) & (same_text == lost["_line_of"]), "left").withColumn("_line_parts", parts)
    places = F.array_except(F.sequence(F.lit(0), F.size("_line_parts") - 1), "_line_lost")
    stay = F.transform(places, lambda at: F.get("_line_parts", at))
    rows = rows.withColumn("_line_stay", F.when(F.col("_line_lost").isNull(), F.col("_line_parts")).otherwise(stay))
    return (
        rows.withColumn("_line_count", F.size("_line_parts").cast("long"))
        .withColumn("_line_dropped", F.size("_line_parts").cast("long") - F.size("_line_stay"))
        .withColumn("_line_text", F.array_join("_line_stay", "\n"))
        .select(*[docs[c] for c in docs.columns], "_line_count", "_line_dropped", "_line_text")
    )
