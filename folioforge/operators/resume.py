"""Pages of an interrupted document and of the pieces that went on with it, merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (``doc``, ``piece``, ``page``, ``complete``, others) that the merged documents have.

    A piece counts through its last complete page. The first one (the base, of least
    ``piece``) does so always, a later one only if it gets further than all before it. A
    page comes from the first piece that counts and has it complete; what stands of it
    elsewhere is dropped, as are incomplete pages. Repeated pages of a piece count once
    (least ``page`` columns first). Rows with a null document, piece or page are dropped.
    """
    rows = pages.dropna(subset=["doc", "piece", "page"]).where("complete")
    ends = rows.groupBy("doc", "piece").agg(F.max("page").alias("last"))
    before = F.max("last").over(Window.partitionBy("doc").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("before", before).where("before is null or last > before").select("doc", "piece")
    rest = [c for c in rows.columns if c not in ("doc", "page", "piece")]
    owned = rows.join(ends, ["doc", "piece"]).groupBy("doc", "page").agg(F.min(F.struct("piece", *rest)).alias("m"))
    return owned.select("doc", "page", "m.*")


def gaps(merged: DataFrame, total: Column | None = None) -> DataFrame:
    """``doc``, ``first`` and ``last`` of each run of pages, from 1 on, that a merged document lacks before one it has, or through its ``total`` if ``merged`` has that column."""
    by = Window.partitionBy("doc").orderBy("page")
    inner = merged.select("doc", (F.coalesce(F.lag("page").over(by), F.lit(0)) + 1).alias("first"), (F.col("page") - 1).alias("last"))
    if total is not None:
        tail = merged.groupBy("doc").agg((F.max("page") + 1).alias("first"), F.max(total).alias("last"))
        inner = inner.unionByName(tail)
    return inner.where("first <= last")
