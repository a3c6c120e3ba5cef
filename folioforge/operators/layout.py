"""Glyphs and pages of a compiled document: what is clipped, where it came from, what moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIDES = ("left", "top", "right", "bottom")


def excess(box: Column, width: float, height: float) -> dict[str, Column]:
    """How far a box stands out of its page at each side."""
    out = (-box[0], -box[1], box[2] - width, box[3] - height)
    return {side: F.greatest(x, F.lit(0.0)) for side, x in zip(SIDES, out, strict=True)}


def overflow(glyphs: DataFrame, width: float, height: float, tolerance: float, samples: int) -> DataFrame:
    """Pages with glyphs that stand out by more than ``tolerance``: how many, how far at each side, and the first few."""
    rows = glyphs.select("page", "glyph", *[x.alias(s) for s, x in excess(F.col("box"), width, height).items()])
    rows = rows.where(F.greatest(*SIDES) > tolerance)
    first = rows.select("page", "glyph").withColumn("_rank", F.row_number().over(Window.partitionBy("page").orderBy("glyph"))).where(F.col("_rank") <= samples)
    first = first.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("glyph")), ",").alias("samples"))
    return rows.groupBy("page").agg(F.count("*").alias("clipped"), *[F.max(s).alias(s) for s in SIDES]).join(first, "page")


#: Pages of a bin by which ranges and pages meet.
BIN = 64


def clipped_sources(page_map: DataFrame, clipped: DataFrame) -> DataFrame:
    """Source pages whose output pages (``start`` to ``end``) hold a clipped one; a range meets pages by the bins it touches."""
    ranges = page_map.where("start <= end").withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN))))
    pages = clipped.select("page").distinct().withColumn("_bin", F.floor(F.col("page") / BIN))
    return ranges.join(pages, "_bin").where(F.col("page").between(F.col("start"), F.col("end"))).select("source_page").distinct()


def source_pages(page_map: DataFrame, outputs: DataFrame) -> DataFrame:
    """The source page of each output page, null outside all ranges."""
    pages = page_map.select("source_page", F.explode(F.sequence("start", "end")).alias("page"))
    return outputs.join(pages, "page", "left")


def content_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Pages whose text differs beyond white space, or that only one side has."""
    plain = lambda rows, name: rows.select(*keys, F.md5(F.array_join(F.split(F.btrim(F.regexp_replace("text", r"\s+", " ")), " "), " ")).alias(name))
    both = plain(before, "_old").join(plain(after, "_new"), keys, "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "lost").when(F.col("_old") != F.col("_new"), "changed")
    return both.select(*keys, change.alias("change")).where("change is not null")


def displacement(before: DataFrame, after: DataFrame, keys: list[str], page: str, tolerance: float) -> DataFrame:
    """Per page the words that are not the same at the same place of the order, and the greatest shift of the others."""
    old = before.select(*keys, F.col("word").alias("_word"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    both = after.select(*keys, "word", "x", "y").join(old, keys, "full")
    same = F.col("word").eqNullSafe(F.col("_word"))
    shift = F.greatest(F.abs(F.col("x") - F.col("_x")), F.abs(F.col("y") - F.col("_y")))
    rows = both.groupBy(page).agg(F.count_if(~same).alias("reordered"), F.coalesce(F.max(F.when(same, shift)), F.lit(0.0)).alias("shift"))
    return rows.withColumn("ok", (F.col("reordered") == 0) & (F.col("shift") <= tolerance))
