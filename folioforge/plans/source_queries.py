"""Queries that write, read back and stream tables, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.plans import adapters as R
from folioforge.session import new_folder
from folioforge.sources import files as B
from folioforge.sources import jsonl as J
from folioforge.streaming import calls as W


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files of the folder of tables."""
    return B.inventory(spark, folder, ".PARQUET").select("path", "length")


def decoded_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as bytes of several encodings, read back."""
    docs = R.frame(spark, folder, "SELECT doc_id, text FROM {documents}")
    content = F.when(F.col("doc_id") % 4 == 0, F.encode("text", "UTF-16")).when(F.col("doc_id") % 4 == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
    content = content.when(F.col("doc_id") % 4 == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))).otherwise(F.encode("text", "UTF-8"))
    return B.decoded(docs, "doc_id", content).select("doc_id", F.md5("text").alias("text_md5"), "encoding", "had_bom", "error")


DECODED = """
SELECT doc_id, md5(text) AS text_md5, CASE doc_id % 4 WHEN 0 THEN 'utf-16-be' WHEN 2 THEN 'utf-16-le' ELSE 'utf-8' END AS encoding, doc_id % 4 <> 3 AS had_bom, CAST(NULL AS VARCHAR) AS error FROM documents
"""
_LEDGER = "id long, source long, day date, source_pages long, elapsed_seconds double"


def _completions(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, R.COMPLETION).select("id", "source", "day", "source_pages", "elapsed_seconds")


def ledger_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Completions appended to a ledger in two writes, read back strictly."""
    path, rows = new_folder(spark, "ledger"), _completions(spark, folder)
    J.write(rows.where("id % 2 = 0"), path)
    J.write(rows.where("id % 2 <> 0"), path)
    return J.read_strict(spark, path, _LEDGER)


LEDGER = f"SELECT id, source, day, source_pages, elapsed_seconds FROM {R.duck(R.COMPLETION)}"


def ledger_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger of which some lines are cut off or no objects: what can be read by day, and how many lines can't."""
    path, rows = new_folder(spark, "malformed"), _completions(spark, folder)
    line = F.to_json(F.struct(*rows.columns))
    broken = F.when(F.col("id") % 10 == 3, F.left(line, F.length(line) - 4)).when(F.col("id") % 10 == 7, F.concat(F.lit("["), line, F.lit("]"))).otherwise(line)
    rows.select(broken.alias("value")).write.text(path)
    good, bad = J.read_counted(spark, path, _LEDGER)
    by_day = good.groupBy("day").agg(F.count("*").alias("n"))
    return by_day.unionByName(bad.agg(F.lit(None).cast("date").alias("day"), F.coalesce(F.sum("malformed"), F.lit(0)).alias("n")))


MALFORMED = f"""
WITH c AS ({LEDGER}) SELECT day, count(*)::BIGINT AS n FROM c WHERE id % 10 NOT IN (3, 7) GROUP BY day UNION ALL SELECT NULL, count(*)::BIGINT FROM c WHERE id % 10 IN (3, 7)
"""


def sheet_verify(spark: SparkSession, folder: str) -> DataFrame:
    """A sheet written and reloaded: rows that only one side has, none if the writer kept all."""
    rows, path = _completions(spark, folder), new_folder(spark, "sheet")
    rows.write.parquet(path)
    again = spark.read.parquet(path)
    lost, extra = rows.exceptAll(again), again.exceptAll(rows)
    return rows.agg(F.count("*").alias("rows")).withColumn("side", F.lit("all")).unionByName(lost.agg(F.count("*").alias("rows")).withColumn("side", F.lit("lost"))).unionByName(extra.agg(F.count("*").alias("rows")).withColumn("side", F.lit("extra")))


SHEET = "SELECT count(*)::BIGINT AS rows, 'all' AS side FROM orders UNION ALL SELECT 0, 'lost' UNION ALL SELECT 0, 'extra'"


def stream_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of calls by a stream over all that is there, read from its snapshots."""
    path = new_folder(spark, "stream-calls")
    W.write_snapshots(W.call_totals(W.event_stream(spark, folder)), path)
    return W.read_snapshot(spark, path, ["user_id"])


STREAM_CALLS = """
SELECT user_id, count(*)::BIGINT AS calls, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS errors, sum(floor(value * 100))::BIGINT AS tokens, max(event_id) AS last_id FROM (SELECT DISTINCT ON (event_id) * FROM events) GROUP BY user_id
"""


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream-latest")
    W.write_snapshots(W.latest_calls(W.event_stream(spark, folder)), path)
    return W.read_snapshot(spark, path, ["user_id", "event_type"])


STREAM_LATEST = "SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY ALL"


def daily_report(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a report: one a day and one for all, as a table of Markdown."""
    rows = _completions(spark, folder).rollup("day").agg(F.count("*").alias("n"), F.sum("source_pages").alias("pages"), F.count_if(F.col("elapsed_seconds").isNull()).alias("gaps"))
    day = F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("total"))
    return rows.select(day.alias("day"), F.format_string("| %s | %d | %d | %s |", day, "n", "pages", F.when(F.col("gaps") > 0, F.concat(F.col("gaps").cast("string"), F.lit(" unknown"))).otherwise("")).alias("line"))


DAILY_REPORT = f"""
SELECT day, printf('| %s | %d | %d | %s |', day, n, pages, CASE WHEN gaps > 0 THEN gaps || ' unknown' ELSE '' END) AS line FROM (
  SELECT coalesce(strftime(day, '%Y-%m-%d'), 'total') AS day, count(*) AS n, sum(source_pages)::BIGINT AS pages, count(*) FILTER (WHERE elapsed_seconds IS NULL) AS gaps FROM ({LEDGER}) GROUP BY ROLLUP (day))
"""

QUERIES = {
    "file_inventory": (file_inventory, None),
    "decoded_texts": (decoded_texts, DECODED),
    "ledger_roundtrip": (ledger_roundtrip, LEDGER),
    "ledger_malformed": (ledger_malformed, MALFORMED),
    "sheet_verify": (sheet_verify, SHEET),
    "stream_calls": (stream_calls, STREAM_CALLS),
    "stream_latest": (stream_latest, STREAM_LATEST),
    "daily_report": (daily_report, DAILY_REPORT),
}
