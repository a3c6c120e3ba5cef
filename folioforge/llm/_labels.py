"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS, F.lit(0)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, target: str, limits: dict[int, int] | int, max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text``, ``label`` and ``fold`` of labelled rows outside fold 0.

    At most ``limits`` rows (of each label, if a dict), those with the least hashes of
    their ids; an id with several labels has the greatest. The result is broadcast-sized
    by these bounds: rows of up to ``SAMPLE_CHARS`` characters.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(target).cast("int").alias("label")).where("_id is not null and label is not null").groupBy("_id").agg(F.max("label").alias("label"))
    known = known.withColumn("fold", fold("_id")).where("fold <> 0")
    rows = docs.where(F.length(text_col) <= max_chars)
    known = known.join(rows.select(F.col(id_col).alias("_id")), "_id", "left_semi")
    ids = None
    for value, limit in limits.items() if isinstance(limits, dict) else [(None, limits)]:
        part = (known if value is None else known.where(F.col("label") == value)).orderBy(F.xxhash64("_id"), "_id").limit(limit)
        ids = part if ids is None else ids.union(part)
    texts = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(ids), "_id").dropDuplicates(["_id"]).select("_id", "text", "label", "fold")
