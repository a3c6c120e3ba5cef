"""Queries over names, labels and reports, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import names as N
from folioforge.plans import adapters as R

PARTS = """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 5 = 1 THEN ' ' END AS hint, CASE WHEN p_partkey % 3 = 0 THEN concat('Table: ', p_type) ELSE '' END AS label,
       CASE WHEN p_partkey % 7 = 0 THEN p_brand END AS caption, CASE WHEN p_partkey % 2 = 0 THEN '---' ELSE NULL END AS heading, p_partkey % 100 AS ordinal, p_size FROM {part}
"""


def table_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, PARTS)
    return rows.select("p_partkey", N.table_name(*[F.col(c) for c in ("hint", "label", "caption", "heading", "ordinal")]).alias("name"))


_SLUG = "left(array_to_string(regexp_extract_all(lower({0}), '[a-z0-9]+'), '_'), 40)"
TABLE_NAMES = f"""
SELECT p_partkey, coalesce(CASE WHEN trim(hint) <> '' THEN rtrim({_SLUG.format('hint')}, '_') END, CASE WHEN label <> '' THEN rtrim({_SLUG.format('label')}, '_') END, CASE WHEN caption <> '' THEN rtrim({_SLUG.format('caption')}, '_') END, printf('tab%02d', ordinal)) AS name FROM {R.duck(PARTS)}
"""


def positional_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}")
    return rows.select(N.positional_names(F.format_string("t%d", F.col("l_orderkey") % 500), F.col("l_linenumber"), F.col("l_partkey") % 9).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


POSITIONAL = "SELECT printf('t%d_r%02d_c%02d', l_orderkey % 500, l_linenumber, l_partkey % 9) AS name, count(*)::BIGINT AS n FROM lineitem GROUP BY 1"
_LABELS = {"BUILDING": "construction", "MACHINERY": "machines", "HOUSEHOLD": "home"}


def segment_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT concat(c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN '_x' ELSE '' END) AS key FROM {customer}")
    return rows.groupBy(N.labelled(F.col("key"), _LABELS).alias("label")).agg(F.count("*").alias("n"))


SEGMENTS = f"""
SELECT CASE key {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items())} ELSE replace(key, '_', ' ') END AS label, count(*)::BIGINT AS n FROM (
  SELECT c_mktsegment || CASE WHEN c_custkey % 4 = 0 THEN '_x' ELSE '' END AS key FROM customer) GROUP BY 1
"""


def progress_texts(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, R.PIPELINE_JOB)
    return jobs.select("id", N.progress_text(F.col("stage"), F.col("position") % 30, F.col("position") % 40, F.col("attempts")).alias("progress"))


PROGRESS_TEXTS = f"""
SELECT id, concat_ws(', ', stage, CASE WHEN position % 40 > 0 THEN printf('%d of %d pages', position % 30, position % 40) END, CASE WHEN attempts > 0 THEN printf('%d unresolved', attempts) END) AS progress FROM {R.duck(R.PIPELINE_JOB)}
"""


def mail_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as the log of an alert."""
    docs = R.frame(spark, folder, "SELECT doc_id, source, text FROM {documents}")
    body = N.mail_body(F.concat(F.lit("alert "), "source"), F.concat(F.lit("document "), "doc_id"), F.concat("text", F.lit(" Authorization: Bearer abcdef")), 2000)
    return docs.select("doc_id", F.length(body).alias("chars"), F.md5(body).alias("body_md5"))


MAIL = f"""
SELECT doc_id, length(b)::INT AS chars, md5(b) AS body_md5 FROM (SELECT doc_id, left('alert ' || source || chr(10) || chr(10) || 'document ' || doc_id || chr(10) || chr(10) ||
  right(text || ' Authorization: Bearer ??????', 1000).replace('??????', '{T.HIDDEN}'), 2000) AS b FROM documents)
"""


def request_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as tables of which the first four rows are sent."""
    cells = R.frame(spark, folder, "SELECT l_orderkey % 3000 AS tbl, l_linenumber AS row, l_partkey, l_suppkey, l_orderkey, CAST(l_partkey AS STRING) AS value FROM {lineitem}")
    return N.request_payload(cells, "tbl", ["l_orderkey", "l_partkey", "l_suppkey"], 4).select("tbl", F.md5("payload").alias("payload_md5"))


PAYLOADS = """
WITH l AS (SELECT l_orderkey % 3000 AS tbl, l_linenumber AS row, string_agg(l_partkey::VARCHAR, ' | ' ORDER BY l_orderkey, l_partkey, l_suppkey) AS line FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL)
SELECT tbl, md5('{"rows":["' || string_agg(line, '","' ORDER BY row) || '"]}') AS payload_md5 FROM l GROUP BY tbl
"""


def convert_report(spark: SparkSession, folder: str) -> DataFrame:
    """Converted tables by where their widths come from."""
    rows = R.frame(spark, folder, PARTS)
    source = F.when(F.col("p_size") > 40, "probe").when(F.col("p_size") > 20, "static").otherwise("default")
    return rows.groupBy(source.alias("source")).agg(F.count("*").alias("tables"), F.sum("p_size").alias("columns"))


CONVERTED = "SELECT CASE WHEN p_size > 40 THEN 'probe' WHEN p_size > 20 THEN 'static' ELSE 'default' END AS source, count(*)::BIGINT AS tables, sum(p_size)::BIGINT AS columns FROM part GROUP BY 1"


def batch_report(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a table of customers as batches; bars in names are escaped."""
    rows = R.frame(spark, folder, "SELECT c_custkey, replace(c_name, '#', '|') AS name, c_mktsegment, c_acctbal >= 0 AS good FROM {customer}")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", T.markdown_cell(F.col("name")), F.lower("c_mktsegment"), F.when(F.col("good"), "done").otherwise("open")), F.lit(" |"))
    return rows.select("c_custkey", line.alias("line"))


BATCH_REPORT = r"SELECT c_custkey, '| ' || replace(replace(c_name, '#', '|'), '|', '\|') || ' | ' || lower(c_mktsegment) || ' | ' || CASE WHEN c_acctbal >= 0 THEN 'done' ELSE 'open' END || ' |' AS line FROM customer"

QUERIES = {
    "table_names": (table_names, TABLE_NAMES),
    "positional_names": (positional_names, POSITIONAL),
    "segment_labels": (segment_labels, SEGMENTS),
    "progress_texts": (progress_texts, PROGRESS_TEXTS),
    "mail_bodies": (mail_bodies, MAIL),
    "request_payloads": (request_payloads, PAYLOADS),
    "convert_report": (convert_report, CONVERTED),
    "batch_report": (batch_report, BATCH_REPORT),
}
