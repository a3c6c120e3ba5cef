"""Batch hierarchies: process, subprocess, step and form with objects in four categories.

An object is ``struct<name, attributes: array<struct<key, value>>>``; attributes keep
their order for display and are compared sorted. Positions come from ``posexplode``,
so first occurrences and column orders stay what the record says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Categories are fixed values of the record format, in order.
CATEGORIES = ("personnel", "materials", "equipment", "environment")
PREFIX = ("batch", "process", "subprocess", "step", "form")


def distinct_objects(objects: Column) -> Column:
    """Objects of one form and category without repeats, first occurrences in order; attribute order doesn't matter."""
    return F.array_distinct(F.transform(F.coalesce(objects, F.array().cast("array<struct<name:string,attributes:array<struct<key:string,value:string>>>>")), lambda o: F.struct(o["name"].alias("name"), F.array_sort(o["attributes"]).alias("attributes"))))


def forms(batches: DataFrame) -> DataFrame:
    """One row a form of nested batches (``process`` of ``subprocess`` of ``step`` of ``form``), with its place and distinct objects."""
    rows = batches.select("batch", F.posexplode("process").alias("p", "process"))
    rows = rows.select("batch", "p", F.col("process.name").alias("process"), F.posexplode("process.subprocess").alias("s", "x"))
    rows = rows.select("batch", "p", "s", "process", F.col("x.name").alias("subprocess"), F.posexplode("x.step").alias("t", "y"))
    rows = rows.select("batch", "p", "s", "t", "process", "subprocess", F.col("y.name").alias("step"), F.posexplode("y.form").alias("f", "z"))
    return rows.select(F.array("p", "s", "t", "f").alias("place"), "batch", "process", "subprocess", "step", F.col("z.name").alias("form"), *[distinct_objects(F.col(f"z.{c}")).alias(c) for c in CATEGORIES])


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.select(*PREFIX, *[F.size(c).alias(c) for c in CATEGORIES])


def long(rows: DataFrame) -> DataFrame:
    """One row an attribute of an object; objects without attributes give one row with a null key."""
    parts = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("category"), F.col(c).alias("objects")) for k, c in enumerate(CATEGORIES)])
    rows = rows.select(*PREFIX, F.explode(parts).alias("c")).select(*PREFIX, "c.k", "c.category", F.posexplode("c.objects").alias("object", "o"))
    return rows.select(*PREFIX, "category", "object", F.col("o.name").alias("name"), F.explode_outer("o.attributes").alias("a")).select(*PREFIX, "category", "object", "name", "a.key", "a.value")


def wide(rows: DataFrame, category: str, keys: list[str]) -> DataFrame:
    """One row an object of a category, with the listed attributes as columns."""
    objects = rows.select(*PREFIX, F.posexplode(category).alias("object", "o"))
    value = lambda k: F.try_element_at(F.transform(F.filter("o.attributes", lambda a: a["key"] == k), lambda a: a["value"]), F.lit(1))
    return objects.select(*PREFIX, "object", F.col("o.name").alias("name"), *[value(k).alias(k) for k in keys])


def merge_runs(rows: DataFrame, sheet: str, order: list[str], prefix: list[str]) -> DataFrame:
    """Runs of neighbouring rows of a sheet with the same prefix: what a sheet shows as one merged cell."""
    by = Window.partitionBy(sheet).orderBy(*order)
    same = F.lit(True)
    for c in prefix:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(by))
    rows = rows.withColumn("row", F.row_number().over(by)).withColumn("new", F.when(same & (F.col("row") > 1), 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(sheet, "run", *prefix).agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"))


#: How dates and times look once numbers are ``#`` and marks of one meaning are one: ``-`` in a date, ``d`` after its day, ``:`` and ``m`` after hours and minutes, ``s`` after seconds.
DATE_SHAPES = ("#-#-#", "#-#-#d")
TIME_SHAPES = ("#:#", "#:#m", "#:#:#", "#:#:#s", "#:#m#", "#:#m#s")
_MARKS = ("年月./日时：分秒", "----d::ms")


def normalize_temporal(value: Column) -> Column:
    """``struct<value, kind>``: ISO dates, times and date-times at their own precision; anything else as it is, kind ``text``."""
    plain = F.regexp_replace(F.translate(F.btrim(F.regexp_replace(value, r"\s", " ")), *_MARKS), " *([-d:ms]) *", "$1")
    n = F.regexp_extract_all(plain, F.lit("[0-9]+"), F.lit(0))
    # A date-time has a space, T, dash or nothing but the mark of the day between date and time.
    shape = F.regexp_replace(F.regexp_replace(plain, "[0-9]+", "#"), "^(#-#-#d?)(?: *[T -] *|(?<=d))(?=#:)", "$1T")
    has_date = shape.isin(*DATE_SHAPES) | F.exists(F.array(*map(F.lit, DATE_SHAPES)), lambda d: shape.startswith(F.concat(d, F.lit("T"))))
    clock_shape = F.when(has_date, F.nullif(F.substring_index(shape, "T", -1), shape)).otherwise(shape)
    has_time = F.coalesce(clock_shape.isin(*TIME_SHAPES), F.lit(False))
    first = F.when(has_date, 3).otherwise(0)
    at = lambda k: F.get(n, k)
    sized = lambda k, least, most: F.length(at(k)).between(least, most)
    day = F.concat_ws("-", at(F.lit(0)), F.lpad(at(F.lit(1)), 2, "0"), F.lpad(at(F.lit(2)), 2, "0"))
    day_ok = F.try_to_date(day, "yyyy-MM-dd").isNotNull() & sized(F.lit(0), 4, 4) & (at(F.lit(0)) != "0000") & sized(F.lit(1), 1, 2) & sized(F.lit(2), 1, 2)
    hour, minute, second = first, first + 1, first + 2
    clock = F.concat_ws(":", F.lpad(at(hour), 2, "0"), at(minute), at(second))
    clock_ok = sized(hour, 1, 2) & sized(minute, 2, 2) & (at(second).isNull() | sized(second, 2, 2)) & (at(hour).try_cast("int") < 24) & (at(minute).try_cast("int") < 60) & (F.coalesce(at(second), F.lit("0")).try_cast("int") < 60)
    is_date, is_time = F.coalesce(has_date & day_ok, F.lit(False)), F.coalesce(has_time & clock_ok, F.lit(False))
    both, date, time = is_date & is_time, is_date & shape.isin(*DATE_SHAPES), is_time & ~has_date
    text = F.when(both, F.concat_ws("-", day, clock)).when(date, day).when(time, clock).otherwise(value)
    return F.struct(text.alias("value"), F.when(both, "datetime").when(date, "date").when(time, "time").otherwise("text").alias("kind"))


def temporal_field(key: Column) -> Column:
    """Whether a key names a date or time; the names are fixed values of the record format."""
    return key.isin("date", "time", "datetime", "valid_until", "effective_until", "validity") | key.rlike("_(date|time|datetime|valid_until|validity)$")
