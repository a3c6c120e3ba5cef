"""Queries over values, times and checks, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import values as V
from folioforge.operators import checks as K
from folioforge.plans import adapters as R


def event_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Instants written and read again, some of them without a zone."""
    rows = R.frame(spark, folder, "SELECT event_id, ts FROM {events}").withColumn("at", F.col("ts").cast("timestamp"))
    text = V.stamp(F.col("at"))
    sent = F.when(F.col("event_id") % 3 == 0, F.left(text, F.lit(19))).otherwise(text)
    return rows.select("event_id", text.alias("stamp"), V.epoch(V.parse_stamp(sent)).alias("epoch"))


STAMPS = """
SELECT event_id, strftime(ts + INTERVAL 8 HOURS, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS stamp, CASE WHEN event_id % 3 <> 0 THEN floor(epoch_us(ts) / 1000000) END::DOUBLE AS epoch FROM events
"""


def elapsed_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT event_id, value * 37 AS spent, event_id % 9 AS done, event_id % 12 AS total FROM {events}")
    return rows.select("event_id", V.elapsed(F.col("spent")).alias("spent"), V.remaining(F.col("spent"), F.col("done"), F.col("total")).alias("remaining"))


def _elapsed(x: str) -> str:
    return f"CASE WHEN {x} < 60 THEN round_even({x}, 0)::BIGINT || 's' WHEN {x} < 3600 THEN floor({x} / 60)::BIGINT || 'm ' || floor({x})::BIGINT % 60 || 's' ELSE floor({x} / 3600)::BIGINT || 'h ' || floor({x})::BIGINT % 3600 // 60 || 'm' END"


ELAPSED = f"""
SELECT event_id, {_elapsed('s')} AS spent, CASE WHEN d > 0 AND t > d THEN '~' || {_elapsed('(s / d * (t - d))')} || ' remaining' END AS remaining FROM (
  SELECT event_id, value * 37 AS s, event_id % 9 AS d, event_id % 12 AS t FROM events)
"""


def cell_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order amounts written in several ways as cells, and documents that fit no cell."""
    orders = R.frame(spark, folder, "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN concat('9', repeat('0', CAST(o_orderkey % 19 AS INT))) WHEN 2 THEN concat(CAST(o_orderkey AS STRING), '.50') ELSE o_orderstatus END AS v FROM {orders}")
    docs = R.frame(spark, folder, "SELECT text FROM {documents}").select(V.cell_problem(F.col("text")).alias("kind"))
    return orders.select(V.cell_kind(F.col("v")).alias("kind")).unionByName(docs).groupBy("kind").agg(F.count("*").alias("n"))


CELLS = r"""
WITH k AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'integer' WHEN 1 THEN CASE WHEN o_orderkey % 19 + 1 > 15 THEN 'text' ELSE 'integer' END WHEN 2 THEN 'number' ELSE 'text' END AS kind FROM orders
  UNION ALL SELECT CASE WHEN length(text) > 32767 THEN 'long' WHEN regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]') THEN 'control' END FROM documents)
SELECT kind, count(*)::BIGINT AS n FROM k GROUP BY kind
"""


def json_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers in the JSON of events, some fenced, cut off, negative or of another kind."""
    rows = R.frame(spark, folder, "SELECT event_id, props, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events}")
    sent = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 5 == 1, F.replace("props", F.lit("}"), F.lit(""))).when(F.col("event_id") % 5 == 2, F.replace("props", F.lit(": "), F.lit(": -1"))).when(F.col("event_id") % 5 == 3, F.lit('{"k": true}')).otherwise(F.col("props"))
    return rows.select("event_id", V.count_of(V.object_of(sent), "$.k").alias("k"))


JSON_COUNTS = "SELECT event_id, CASE WHEN event_id % 5 IN (0, 4) THEN CAST(props->>'$.k' AS BIGINT) END AS k FROM events"


def acceptance_gates(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT c_custkey, c_custkey % 100 / 100.0D AS critical, 0.9D + c_custkey % 11 / 100.0D AS table, 0.97D + c_custkey % 4 / 100.0D AS checkbox, 0.55D + c_custkey % 50 / 100.0D AS speed, c_custkey % 7 AS documents FROM {customer}")
    return K.acceptance(rows).select("c_custkey", F.array_join("missed", ",").alias("missed"))


GATES = """
SELECT c_custkey, concat_ws(',', CASE WHEN NOT (c BETWEEN 0.30::DOUBLE AND 1) THEN 'critical' END, CASE WHEN NOT (t BETWEEN 0.95::DOUBLE AND 1) THEN 'table' END, CASE WHEN NOT (b BETWEEN 0.98::DOUBLE AND 1) THEN 'checkbox' END,
  CASE WHEN NOT (s BETWEEN 0.60::DOUBLE AND 1) THEN 'speed' END, CASE WHEN c_custkey % 7 <> 5 THEN 'documents' END) AS missed FROM (
  SELECT c_custkey, c_custkey % 100 / 100.0::DOUBLE AS c, 0.9::DOUBLE + c_custkey % 11 / 100.0::DOUBLE AS t, 0.97::DOUBLE + c_custkey % 4 / 100.0::DOUBLE AS b, 0.55::DOUBLE + c_custkey % 50 / 100.0::DOUBLE AS s FROM customer)
"""


def upload_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as uploads: some say another size or digest than they have."""
    docs = R.frame(spark, folder, "SELECT doc_id, text FROM {documents}").withColumn("content", F.encode("text", "UTF-8"))
    size = F.octet_length("content") + F.when(F.col("doc_id") % 8 == 0, 1).otherwise(0)
    rows = docs.select("doc_id", "content", size.alias("size"), F.when(F.col("doc_id") % 9 == 0, F.upper(F.sha2("content", 256))).otherwise(F.sha2("content", 256)).alias("sha256"))
    return K.uploads(rows, 20_000).select("doc_id", F.array_join("problems", ",").alias("problems"))


UPLOADS = """
SELECT doc_id, concat_ws(',', CASE WHEN s NOT BETWEEN 1 AND 20000 THEN 'size' END, CASE WHEN doc_id % 9 = 0 THEN 'sha256' END, CASE WHEN doc_id % 8 = 0 THEN 'length' END, CASE WHEN doc_id % 9 = 0 THEN 'digest' END) AS problems
FROM (SELECT doc_id, strlen(text) + CASE WHEN doc_id % 8 = 0 THEN 1 ELSE 0 END AS s FROM documents)
"""


def provider_checks(spark: SparkSession, folder: str) -> DataFrame:
    pages = R.frame(spark, folder, "SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://me@') WHEN 2 THEN substr(url, 5) ELSE split_part(split_part(url, '?', 1), '#', 1) END AS url, CASE WHEN page_id % 6 = 0 THEN '  ' ELSE 'k' END AS key FROM {pages}")
    return pages.select("page_id", F.array_join(K.provider_problems(F.col("url"), F.col("key")), ",").alias("problems"))


PROVIDERS = """
SELECT page_id, concat_ws(',', CASE WHEN NOT regexp_matches(u, '^(?i)https?://[^/]') THEN 'scheme' END, CASE WHEN page_id % 4 = 1 THEN 'user' END, CASE WHEN regexp_matches(u, '[?#]') THEN 'query' END, CASE WHEN page_id % 6 = 0 THEN 'key' END) AS problems FROM (
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://me@') WHEN 2 THEN substr(url, 5) ELSE split_part(split_part(url, '?', 1), '#', 1) END AS u FROM pages)
"""


def plan_checks(spark: SparkSession, folder: str) -> DataFrame:
    """A plan of parts over workers in which some are missing, twice, unknown or with the wrong worker."""
    parts = R.frame(spark, folder, "SELECT p_partkey AS source, p_partkey % 3 + 1 AS worker FROM {part}")
    plan = parts.where("source % 50 <> 0").unionByName(parts.where("source % 77 = 0")).unionByName(parts.where("source % 90 = 0").withColumn("source", -F.col("source") - 1))
    return K.plan_problems(plan, parts, parts.where("source % 6 = 1"))


PLAN_CHECKS = """
WITH s AS (SELECT p_partkey AS source, p_partkey % 3 + 1 AS worker FROM part), p AS (SELECT * FROM s WHERE source % 50 <> 0 UNION ALL SELECT * FROM s WHERE source % 77 = 0 UNION ALL SELECT -source - 1, worker FROM s WHERE source % 90 = 0),
a AS (SELECT source, count(*) AS times, max(worker) AS worker FROM p GROUP BY source)
SELECT * FROM (SELECT source, CASE WHEN s.worker IS NULL THEN 'unknown' WHEN times IS NULL THEN 'missing' WHEN times > 1 THEN 'twice' WHEN source % 6 = 1 AND a.worker <> 1 THEN 'not pinned' END AS problem FROM s FULL JOIN a USING (source)) WHERE problem IS NOT NULL
"""


def label_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Part types of lines that no label names, and what is wrong with each line's keys."""
    kinds = R.frame(spark, folder, "SELECT p_type AS key FROM {lineitem} JOIN {part} ON l_partkey = p_partkey")
    labels = R.frame(spark, folder, "SELECT DISTINCT p_type AS key FROM {part} WHERE p_type < 'M'")
    return K.unlabelled(kinds, labels, "key")


LABELS = "SELECT p_type AS key, count(*)::BIGINT AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type >= 'M' GROUP BY p_type"


def mapping_checks(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT o_orderkey, array_compact(array(CASE WHEN o_orderkey % 2 = 0 THEN 'name' END, CASE WHEN o_orderkey % 3 = 0 THEN 'step' END, CASE WHEN o_orderkey % 5 = 0 THEN 'form' END, CASE WHEN o_orderkey % 7 = 0 THEN 'extra' END)) AS keys FROM {orders}")
    return rows.select("o_orderkey", F.array_join(K.key_problems(F.col("keys"), ("name", "step"), ("form",)), ",").alias("problems"))


MAPPINGS = "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 2 <> 0 THEN '-name' END, CASE WHEN o_orderkey % 3 <> 0 THEN '-step' END, CASE WHEN o_orderkey % 7 = 0 THEN '+extra' END) AS problems FROM orders"

QUERIES = {
    "event_stamps": (event_stamps, STAMPS),
    "elapsed_texts": (elapsed_texts, ELAPSED),
    "cell_values": (cell_values, CELLS),
    "json_counts": (json_counts, JSON_COUNTS),
    "acceptance_gates": (acceptance_gates, GATES),
    "upload_checks": (upload_checks, UPLOADS),
    "provider_checks": (provider_checks, PROVIDERS),
    "plan_checks": (plan_checks, PLAN_CHECKS),
    "label_gaps": (label_gaps, LABELS),
    "mapping_checks": (mapping_checks, MAPPINGS),
}
