"""Fields of a document against their registry, evidence and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(c: Column) -> Column:
    return F.nullif(F.btrim(c), F.lit(""))


def filled(fields: DataFrame, registry: DataFrame, columns: list[str], fallback: dict[str, str]) -> DataFrame:
    """``fields`` with blank ``columns`` filled from the registry's row of the same ``field_id``, then from its column that ``fallback`` names."""
    known = registry.select("field_id", *[F.col(c).alias(f"_r_{c}") for c in registry.columns if c != "field_id"])
    rows = fields.join(known, "field_id", "left")
    for c in columns:
        other = [_blank(F.col(f"_r_{fallback[c]}"))] if c in fallback else []
        rows = rows.withColumn(c, F.coalesce(_blank(F.col(c)), _blank(F.col(f"_r_{c}")), *other, F.lit("")))
    return rows.select(*fields.columns)


def provenance_problems(records: DataFrame, provenance: DataFrame) -> DataFrame:
    """Why records and their provenance are not the same ids, once each, with the same values: one row a field and problem."""
    sides = [rows.groupBy("field_id").agg(F.count("*").alias(f"n_{name}"), F.min("value").alias(f"value_{name}")) for rows, name in ((records, "record"), (provenance, "provenance"))]
    both = sides[0].join(sides[1], "field_id", "full")
    n, m = F.coalesce("n_record", F.lit(0)), F.coalesce("n_provenance", F.lit(0))
    problem = F.when((n > 1) | (m > 1), "duplicate").when(n == 0, "unknown").when(m == 0, "missing").when(~F.lower("value_record").eqNullSafe(F.lower("value_provenance")), "value")
    return both.select("field_id", problem.alias("problem")).where("problem is not null")


def evidence_problems(fields: DataFrame, segments: DataFrame) -> DataFrame:
    """Fields without exactly one text segment on their page are errors; segments of no field are warnings."""
    found = segments.groupBy("field_id").agg(F.count("*").alias("n"), F.min("page").alias("segment_page"))
    rows = fields.select("field_id", "page").join(found, "field_id", "full")
    kind = F.when(F.col("page").isNull(), "extra").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(F.col("page") != F.col("segment_page"), "page")
    return rows.select("field_id", kind.alias("problem"), F.when(kind == "extra", "warning").otherwise("error").alias("severity")).where("problem is not null")


def stamped(records: DataFrame, evidence: DataFrame, columns: list[str]) -> DataFrame:
    """``records`` with ``columns`` of their evidence, where a field has one row of it and on the same page."""
    one = evidence.groupBy("field_id").agg(F.count("*").alias("_n"), F.min("page").alias("_page"), *[F.any_value(c).alias(c) for c in columns]).where("_n = 1")
    rows = records.join(one, "field_id", "left")
    same = F.col("_page") == F.col("page")
    return rows.select(*records.columns, *[F.when(same, F.col(c)).alias(c) for c in columns])


def naming_plan(fields: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (``page``, ``field_id``), and for the fields that none covers one request a page with their number."""
    rest = fields.select("field_id", "page").join(requests.select("field_id").distinct(), "field_id", "left_anti")
    return rest.groupBy("page").agg(F.count("*").alias("fields"), F.min("field_id").alias("first_field"))


def enriched(records: DataFrame, names: DataFrame, request: str) -> DataFrame:
    """``records`` with the names of their fields; a request that names any unknown field is left out whole."""
    known = names.join(records.select("field_id", F.lit(True).alias("_known")), "field_id", "left")
    bad = known.where("_known is null").select(request).distinct()
    good = names.join(bad, request, "left_anti").groupBy("field_id").agg(F.min("name").alias("name"))
    return records.join(good, "field_id", "left")


def merged(reports: DataFrame, keys: list[str]) -> DataFrame:
    """Reports as one: their fields, the greatest number of pages and the handwritten fields."""
    return reports.groupBy(*keys).agg(F.count("*").alias("total_fields"), F.max("page").alias("total_pages"), F.count_if("handwritten").alias("handwritten"))


def ids_equal(asked: DataFrame, replied: DataFrame, key: str) -> DataFrame:
    """Whether each request's reply has its ids, each once and no others."""
    a = asked.groupBy(key, "field_id").agg(F.count("*").alias("asked"))
    r = replied.groupBy(key, "field_id").agg(F.count("*").alias("replied"))
    both = a.join(r, [key, "field_id"], "full")
    return both.groupBy(key).agg(F.every(F.coalesce((F.col("asked") == 1) & (F.col("replied") == 1), F.lit(False))).alias("equal"))
