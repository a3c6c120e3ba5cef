"""The place of every row in one order over a whole table, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import kept


def ranked(rows: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """``rows`` with their place, from 1, in ``order`` (which should leave no ties: these get places in any order).

    Rows are dealt by ranges of the order; the number of rows of each range, a few numbers,
    gives the ranges their first places. Nulls stand where the order puts them; an empty
    table stays empty.
    """
    ranges = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = kept(ranges, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranges.join(F.broadcast(sizes), "_range").withColumn(rank, F.col("_before") + place).select(*rows.columns, rank)


def natural(name: Column, digits: int = 20) -> Column:
    """A key that compares names without regard to case and accents, and numbers in them by their size.

    Numbers of up to ``digits`` digits count, leading zeros don't; a null name is null.
    """
    runs = F.regexp_extract_all(name, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    padded = F.transform(runs, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(F.ltrim(x, F.lit("0")), digits, "0")).otherwise(x))
    return F.collate(F.array_join(padded, ""), "UNICODE_CI_AI")
