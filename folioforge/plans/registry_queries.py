"""Queries over fields, their registry and evidence, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import registry as G
from folioforge.plans import adapters as R

#: Parts as fields: some without a label or value, and the registry of most of them.
FIELDS = """
SELECT p_partkey AS field_id, p_partkey % 40 AS page, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name END AS label, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS value,
       p_brand AS request, p_size > 25 AS handwritten FROM {part}
"""
REGISTRY = """
SELECT p_partkey AS field_id, p_partkey % 41 AS page, CASE WHEN p_partkey % 2 = 0 THEN concat('label ', p_name) ELSE '' END AS label, lower(p_type) AS value, concat('meaning ', p_brand) AS semantic, p_retailprice AS price
FROM {part} WHERE p_partkey % 7 <> 0
"""
#: Lines as pieces of evidence: those of one supplier in forty belong to the part itself, the others to fields of their own.
SEGMENTS = """
SELECT CASE WHEN l_suppkey % 40 = l_partkey % 40 THEN l_partkey ELSE 1000000000 + l_partkey * 4 + l_suppkey % 4 END AS field_id, MIN(l_partkey % 40 + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS page, l_suppkey
FROM {lineitem} GROUP BY 1, l_partkey, l_suppkey
"""


def _frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return R.frame(spark, folder, FIELDS), R.frame(spark, folder, REGISTRY)


def registry_fill(spark: SparkSession, folder: str) -> DataFrame:
    fields, known = _frames(spark, folder)
    return G.filled(fields, known, ["label", "value"], {"label": "semantic"}).select("field_id", "label", "value")


FILL = f"""
SELECT f.field_id, coalesce(nullif(trim(f.label), ''), nullif(trim(r.label), ''), nullif(trim(r.semantic), ''), '') AS label, coalesce(nullif(trim(f.value), ''), nullif(trim(r.value), ''), '') AS value
FROM {R.duck(FIELDS)} f LEFT JOIN {R.duck(REGISTRY)} r USING (field_id)
"""


def registry_problems(spark: SparkSession, folder: str) -> DataFrame:
    fields, known = _frames(spark, folder)
    return G.provenance_problems(fields.where("field_id % 11 <> 0").union(fields.where("field_id % 97 = 0")), known)


PROBLEMS = f"""
WITH f AS (SELECT * FROM {R.duck(FIELDS)}), a AS (SELECT field_id, value FROM f WHERE field_id % 11 <> 0 UNION ALL SELECT field_id, value FROM f WHERE field_id % 97 = 0),
x AS (SELECT field_id, count(*) AS n, min(value) AS v FROM a GROUP BY 1), y AS (SELECT field_id, count(*) AS n, min(value) AS v FROM {R.duck(REGISTRY)} GROUP BY 1)
SELECT * FROM (SELECT field_id, CASE WHEN x.n > 1 OR y.n > 1 THEN 'duplicate' WHEN x.n IS NULL THEN 'unknown' WHEN y.n IS NULL THEN 'missing' WHEN lower(x.v) IS DISTINCT FROM lower(y.v) THEN 'value' END AS problem
FROM x FULL JOIN y USING (field_id)) WHERE problem IS NOT NULL
"""


def evidence_segments(spark: SparkSession, folder: str) -> DataFrame:
    fields, _ = _frames(spark, folder)
    return G.evidence_problems(fields.where("field_id % 13 <> 0"), R.frame(spark, folder, SEGMENTS))


SEGMENT_PROBLEMS = f"""
WITH s AS (SELECT field_id, count(*) AS n, min(page) AS page FROM {R.duck(SEGMENTS)} GROUP BY 1), f AS (SELECT field_id, page FROM {R.duck(FIELDS)} WHERE field_id % 13 <> 0)
SELECT *, CASE problem WHEN 'extra' THEN 'warning' ELSE 'error' END AS severity FROM (
  SELECT field_id, CASE WHEN f.page IS NULL THEN 'extra' WHEN s.n IS NULL THEN 'missing' WHEN s.n > 1 THEN 'duplicate' WHEN f.page <> s.page THEN 'page' END AS problem FROM f FULL JOIN s USING (field_id)) WHERE problem IS NOT NULL
"""


def stamp_registry(spark: SparkSession, folder: str) -> DataFrame:
    fields, _ = _frames(spark, folder)
    return G.stamped(fields.select("field_id", "page"), R.frame(spark, folder, SEGMENTS), ["l_suppkey"])


STAMPED = f"""
WITH s AS (SELECT field_id, min(page) AS page, min(l_suppkey) AS l_suppkey FROM {R.duck(SEGMENTS)} GROUP BY 1 HAVING count(*) = 1)
SELECT f.field_id, f.page, CASE WHEN s.page = f.page THEN s.l_suppkey END AS l_suppkey FROM {R.duck(FIELDS)} f LEFT JOIN s USING (field_id)
"""


def naming_plan(spark: SparkSession, folder: str) -> DataFrame:
    fields, _ = _frames(spark, folder)
    return G.naming_plan(fields, R.frame(spark, folder, SEGMENTS))


NAMING = f"SELECT page, count(*)::BIGINT AS fields, min(field_id) AS first_field FROM {R.duck(FIELDS)} WHERE field_id NOT IN (SELECT field_id FROM {R.duck(SEGMENTS)}) GROUP BY page"


def naming_enrich(spark: SparkSession, folder: str) -> DataFrame:
    fields, known = _frames(spark, folder)
    names = known.select("field_id", F.col("semantic").alias("name"), (F.col("field_id") % 150).alias("request"))
    return G.enriched(fields.where("field_id % 83 <> 0").select("field_id", "page"), names, "request")


ENRICHED = f"""
WITH f AS (SELECT field_id, page FROM {R.duck(FIELDS)} WHERE field_id % 83 <> 0), n AS (SELECT field_id, semantic AS name, field_id % 150 AS request FROM {R.duck(REGISTRY)}),
bad AS (SELECT DISTINCT request FROM n WHERE field_id NOT IN (SELECT field_id FROM f))
SELECT f.field_id, f.page, n.name FROM f LEFT JOIN (SELECT * FROM n WHERE request NOT IN (SELECT request FROM bad)) n USING (field_id)
"""


def merged_report(spark: SparkSession, folder: str) -> DataFrame:
    return G.merged(R.frame(spark, folder, FIELDS), ["request"])


MERGED = f"SELECT request, count(*)::BIGINT AS total_fields, max(page) AS total_pages, count(*) FILTER (WHERE handwritten)::BIGINT AS handwritten FROM {R.duck(FIELDS)} GROUP BY request"


def request_ids_equal(spark: SparkSession, folder: str) -> DataFrame:
    fields, known = _frames(spark, folder)
    of = (F.col("field_id") % 300).alias("batch")
    return G.ids_equal(fields.select(of, "field_id"), known.select(of, "field_id"), "batch")


IDS_EQUAL = f"SELECT field_id % 300 AS batch, bool_and(field_id IN (SELECT field_id FROM {R.duck(REGISTRY)})) AS equal FROM {R.duck(FIELDS)} GROUP BY 1"

QUERIES = {
    "registry_fill": (registry_fill, FILL),
    "registry_problems": (registry_problems, PROBLEMS),
    "evidence_segments": (evidence_segments, SEGMENT_PROBLEMS),
    "stamp_registry": (stamp_registry, STAMPED),
    "naming_plan": (naming_plan, NAMING),
    "naming_enrich": (naming_enrich, ENRICHED),
    "merged_report": (merged_report, MERGED),
    "request_ids_equal": (request_ids_equal, IDS_EQUAL),
}
