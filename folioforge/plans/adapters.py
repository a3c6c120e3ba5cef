"""Domain relations over the driver's tables, as SQL that Spark and DuckDB both run.

Tables stand in braces: Spark binds frames to them, DuckDB reads the views of those
names. ``floor`` comes before every cast to an integer, because the engines round
casts differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from folioforge.session import table

#: One row a billed model call; lines of an order repeat ids, so ``called_at`` to ``rank3`` order them.
BILLING_CALL = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS call_id, l_orderkey AS doc_id,
       CASE l_returnflag WHEN 'A' THEN 'alpha' WHEN 'N' THEN 'nova' ELSE 'unlisted' END AS model,
       CAST(floor(l_extendedprice) AS BIGINT) AS input_tokens,
       CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS cached_input_tokens,
       CAST(floor(l_extendedprice * l_tax) AS BIGINT) AS cache_write_tokens,
       CAST(floor(l_quantity * 100) AS BIGINT) AS output_tokens,
       l_tax = 0 AS cache_usage_unreported,
       l_shipdate AS called_at, l_partkey AS rank1, l_suppkey AS rank2, l_extendedprice AS rank3, l_quantity AS rank4
FROM {lineitem}
"""
CALL_ORDER = ("called_at", "rank1", "rank2", "rank3", "rank4")

#: One row a completed document; its day is the local one, eight hours ahead of UTC.
COMPLETION = """
SELECT o_orderkey AS id, o_custkey AS source, o_orderdate AS completed_at,
       CAST(o_orderdate + INTERVAL 8 HOURS AS DATE) AS day,
       CAST(floor(o_totalprice) AS BIGINT) % 90 + 1 AS source_pages,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 7200 AS DOUBLE) END AS elapsed_seconds,
       o_orderkey % 13 = 0 AS missing_logs
FROM {orders}
"""

#: One row a job of a stage.
PIPELINE_JOB = """
SELECT o_orderkey AS id, o_custkey AS source,
       CASE o_orderkey % 3 WHEN 0 THEN 'recognize' WHEN 1 THEN 'reconcile' ELSE 'optimise' END AS stage,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'retry' END AS status,
       CAST(o_orderkey % 5 AS INT) AS attempts, o_orderdate AS updated_at,
       o_orderdate + INTERVAL 6 MINUTES AS next_retry_at, CAST(floor(o_totalprice) AS BIGINT) AS position
FROM {orders}
"""

#: One row a logged model-call event.
CALL_EVENT = """
SELECT event_id AS call_id, user_id AS doc_id, ts AS called_at, value AS seconds, event_id AS seq,
       CASE event_type WHEN 'view' THEN 'recognize' WHEN 'click' THEN 'reconcile' WHEN 'purchase' THEN 'optimise'
                       WHEN 'signup' THEN 'naming' ELSE 'recognize' END AS stage,
       CASE WHEN event_id % 9 = 4 THEN 'start' ELSE 'finish' END AS event,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
       CAST(1 + event_id % 3 AS INT) AS attempt,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END AS input_tokens,
       CASE WHEN event_id % 10 = 1 THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END AS output_tokens
FROM {events}
"""

#: Marked-up pages: a marker line closes every fifth line, and the text may end without one.
TEX_DOCUMENT = """
SELECT doc_id, source, lang, replace(text, '$', '') AS text FROM {documents}
"""


def names(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def frame(spark: SparkSession, folder: str, sql: str, **frames: DataFrame) -> DataFrame:
    """The relation that ``sql`` describes, from tables of ``folder`` unless given."""
    return spark.sql(sql, **{n: frames.get(n, None) if n in frames else table(spark, folder, n) for n in names(sql)})


def duck(sql: str) -> str:
    """The same text for DuckDB's views, as a subquery."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", sql).strip() + ")"
