"""Lines of documents: what stands above, around and in a row, by windows within a document.

Frames have the document's ``key``, ``line_no`` from 1 and ``line``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def lines_of(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(F.split(text_col, "\n", -1)).alias("at", "line")).select(key, (F.col("at") + 1).alias("line_no"), "line")


def _so_far(key: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def headed(lines: DataFrame, key: str, is_heading: Column) -> DataFrame:
    """Adds ``heading``: the last heading at or above the line."""
    return lines.withColumn("heading", F.last(F.when(is_heading, F.col("line")), ignorenulls=True).over(_so_far(key)))


def marked_above(lines: DataFrame, key: str, is_marker: Column, is_barrier: Column, reach: int) -> DataFrame:
    """Adds ``marker_line``: the nearest marker at or above the line, at most ``reach`` lines away and below the last barrier above it."""
    rows = lines.withColumn("_marker", is_marker).withColumn("_part", F.sum(F.when(is_barrier, 1).otherwise(0)).over(_so_far(key)))
    within = Window.partitionBy(key, "_part").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("_marker"), F.col("line_no"))).over(within)
    return rows.withColumn("marker_line", F.when(F.col("line_no") - last <= reach, last)).drop("_marker", "_part")


def captioned(lines: DataFrame, key: str, is_caption: Column, before: int, after: int) -> DataFrame:
    """Adds ``caption_line``: the first caption from ``before`` lines above to ``after`` below."""
    around = Window.partitionBy(key).orderBy("line_no").rowsBetween(-before, after)
    return lines.withColumn("caption_line", F.min(F.when(is_caption, F.col("line_no"))).over(around))


def paged(lines: DataFrame, key: str, marker: Column, is_break: Column) -> DataFrame:
    """Adds ``page``: the last explicit ``marker`` above; until the first, one more at each break, whose line is the new page's."""
    by = _so_far(key)
    rows = lines.withColumn("_marker", marker).withColumn("_breaks", F.sum(F.when(is_break, 1).otherwise(0)).over(by))
    return rows.withColumn("page", F.coalesce(F.last("_marker", ignorenulls=True).over(by), F.col("_breaks") + 1)).drop("_marker", "_breaks")


def runs(lines: DataFrame, key: str, inside: Column, least: int) -> DataFrame:
    """Runs of at least ``least`` neighbouring lines for which ``inside`` holds: first and last line."""
    rows = lines.withColumn("_in", F.coalesce(inside, F.lit(False)))
    rows = rows.withColumn("_run", F.col("line_no") - F.row_number().over(Window.partitionBy(key, "_in").orderBy("line_no")))
    found = rows.where("_in").groupBy(key, "_run").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
    return found.drop("_run").where(F.col("last_line") - F.col("first_line") + 1 >= least)


def legacy_ids(rows: DataFrame, keys: list[str], order: list[str], page: Column, own: Column) -> DataFrame:
    """Adds ``field_id``: a row's own, or the page's next one of the old form."""
    missing = own.isNull()
    place = F.sum(F.when(missing, 1).otherwise(0)).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("field_id", F.coalesce(own, F.format_string("LEX-P%04d-V%04d", page.cast("int"), place.cast("int"))))


def excerpts(lines: DataFrame, errors: DataFrame, key: str, before: int, after: int) -> DataFrame:
    """The numbered lines around each of ``errors`` (``key``, ``error_line``), as one text.

    An error asks for its lines by number, so only they meet it.
    """
    around = F.sequence(F.greatest(F.col("error_line") - before, F.lit(1)), F.col("error_line") + after)
    wanted = errors.select(key, "error_line", F.explode(around).alias("line_no"))
    found = wanted.join(lines, [key, "line_no"]).select(key, "error_line", F.struct("line_no", F.format_string("%d: %s", "line_no", "line").alias("t")).alias("x"))
    return found.groupBy(key, "error_line").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("excerpt"))
