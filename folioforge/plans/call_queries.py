"""Queries over model calls, logs and probes, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import calls as C
from folioforge.plans import adapters as R

_EVENTS = R.duck(R.CALL_EVENT)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, R.CALL_EVENT)


def billing_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the calls that each completion is charged with, from the logs."""
    wanted = R.frame(spark, folder, R.COMPLETION).select("source", F.col("id").alias("call_id")).withColumnRenamed("source", "id")
    return C.billing_backfill(wanted, _events(spark, folder).where("event = 'finish'"), ["seq"])


BACKFILL = f"""
WITH f AS (SELECT call_id, input_tokens, output_tokens FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY seq) AS k FROM {_EVENTS} WHERE event = 'finish') WHERE k = 1)
SELECT c.source AS id, count(*)::BIGINT AS calls, count(*) FILTER (WHERE f.call_id IS NULL)::BIGINT AS missing, sum(f.input_tokens)::BIGINT AS input_tokens, sum(f.output_tokens)::BIGINT AS output_tokens
FROM {R.duck(R.COMPLETION)} c LEFT JOIN f ON f.call_id = c.id GROUP BY c.source
"""


def page_status(spark: SparkSession, folder: str) -> DataFrame:
    calls = _events(spark, folder).where("event = 'finish'").withColumn("page", (F.col("call_id") % 12).cast("int"))
    return C.page_states(calls, ["doc_id", "page"])


PAGE_STATUS = f"""
SELECT doc_id, page, CASE WHEN status = 'error' THEN 'failed' WHEN attempt > 1 THEN 'retried' ELSE 'done' END AS state, stage, calls FROM (
  SELECT doc_id, (call_id % 12)::INT AS page, arg_max(status, (called_at, call_id)) AS status, arg_max(attempt, (called_at, call_id)) AS attempt, arg_max(stage, (called_at, call_id)) AS stage, count(*)::BIGINT AS calls
  FROM {_EVENTS} WHERE event = 'finish' GROUP BY ALL)
"""


def job_observation(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, "SELECT c_custkey AS doc_id, CAST(60 + c_custkey % 50 AS BIGINT) AS pages FROM {customer}")
    rows = C.observation(_events(spark, folder).where("event = 'finish'"), jobs, 4)
    return rows.select("doc_id", "pages", "calls", "input_tokens", "known_input_tokens", "done", "remaining", F.round("eta_seconds", 6).alias("eta_seconds"))


OBSERVATION = f"""
WITH t AS (SELECT doc_id, count(*)::BIGINT AS calls, CASE WHEN count(input_tokens) = count(*) THEN sum(input_tokens)::BIGINT END AS input_tokens, coalesce(sum(input_tokens), 0)::BIGINT AS known_input_tokens,
  count(*) FILTER (WHERE stage = 'recognize' AND status = 'ok')::BIGINT AS done, avg(seconds) FILTER (WHERE stage = 'recognize' AND status = 'ok') AS mean FROM {_EVENTS} WHERE event = 'finish' GROUP BY doc_id),
j AS (SELECT c_custkey AS doc_id, (60 + c_custkey % 50)::BIGINT AS pages FROM customer)
SELECT doc_id, pages, calls, input_tokens, known_input_tokens, done, greatest(pages - coalesce(done, 0), 0)::BIGINT AS remaining, round(mean * greatest(pages - coalesce(done, 0), 0) / 4, 6) AS eta_seconds FROM j LEFT JOIN t USING (doc_id)
"""


def evidence_union(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that any log completes, less those that fell back, and the latest call of each id over all logs."""
    logs = _events(spark, folder).withColumn("page", F.col("call_id") % 20)
    done = logs.groupBy("doc_id").agg(F.collect_set(F.when(F.col("status") == "ok", F.col("page"))).alias("done"), F.collect_set(F.when(F.col("attempt") == 3, F.col("page"))).alias("fallback"))
    return done.select("doc_id", F.array_join(F.array_sort(F.array_except("done", "fallback")), ",").alias("pages"))


EVIDENCE = f"""
WITH l AS (SELECT *, call_id % 20 AS page FROM {_EVENTS}), d AS (SELECT DISTINCT doc_id, page FROM l WHERE status = 'ok' EXCEPT SELECT doc_id, page FROM l WHERE attempt = 3)
SELECT x.doc_id, coalesce(string_agg(d.page::VARCHAR, ',' ORDER BY d.page), '') AS pages FROM (SELECT DISTINCT doc_id FROM l) x LEFT JOIN d USING (doc_id) GROUP BY x.doc_id
"""


def calls_union(spark: SparkSession, folder: str) -> DataFrame:
    """The logs of two passes as one: the later record of a call wins."""
    first = _events(spark, folder).select("call_id", "stage", "status", F.lit(1).alias("pass"))
    second = first.where("call_id % 4 = 0").select("call_id", F.lit("optimise").alias("stage"), F.lit("ok").alias("status"), F.lit(2).alias("pass"))
    return C.latest_by(first.unionByName(second), ["call_id"], ["pass"]).groupBy("stage", "status", "pass").agg(F.count("*").alias("calls"))


UNION_CALLS = f"""
SELECT CASE WHEN call_id % 4 = 0 THEN 'optimise' ELSE stage END AS stage, CASE WHEN call_id % 4 = 0 THEN 'ok' ELSE status END AS status, CASE WHEN call_id % 4 = 0 THEN 2 ELSE 1 END AS pass, count(*)::BIGINT AS calls FROM {_EVENTS} GROUP BY ALL
"""


def stage_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What each document's log says since its last attempt began: events, pages seen and the last stage."""
    last = C.last_attempt(_events(spark, folder), "doc_id", ["seq"], F.col("stage") == "naming")
    return last.groupBy("doc_id").agg(F.max("attempt_no").alias("attempts"), F.count("*").alias("events"), F.countDistinct(F.col("call_id") % 30).alias("pages"), F.max_by("stage", "seq").alias("stage"), F.count_if(F.col("status") == "error").alias("unresolved"))


PROGRESS = f"""
WITH a AS (SELECT *, sum(CASE WHEN stage = 'naming' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY seq) AS n FROM {_EVENTS}), m AS (SELECT *, max(n) OVER (PARTITION BY doc_id) AS top FROM a)
SELECT doc_id, max(n)::BIGINT AS attempts, count(*)::BIGINT AS events, count(DISTINCT call_id % 30)::BIGINT AS pages, arg_max(stage, seq) AS stage, count(*) FILTER (WHERE status = 'error')::BIGINT AS unresolved FROM m WHERE n = top GROUP BY doc_id
"""


def queue_progress(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, R.PIPELINE_JOB)
    return jobs.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.every(F.col("status") == "completed").alias("finished"))


QUEUES = f"SELECT source, count(*)::BIGINT AS total, count(*) FILTER (WHERE status = 'completed')::BIGINT AS completed, bool_and(status = 'completed') AS finished FROM {R.duck(R.PIPELINE_JOB)} GROUP BY source"


def sync_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Transfers by stage: how many, how many went well, and the first 20 that failed."""
    events = _events(spark, folder)
    failed = C.first_of_each(events.where("status = 'error'"), ["stage"], ["seq"], "call_id", 20)
    totals = events.groupBy("stage").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"))
    return totals.join(failed, "stage", "left").select("stage", "total", "ok", F.array_join(F.coalesce("first", F.array().cast("array<bigint>")), ",").alias("failures"))


SYNC = f"""
SELECT stage, count(*)::BIGINT AS total, count(*) FILTER (WHERE status = 'ok')::BIGINT AS ok, coalesce(array_to_string((list(call_id ORDER BY seq) FILTER (WHERE status = 'error'))[1:20], ','), '') AS failures FROM {_EVENTS} GROUP BY stage
"""


def log_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """Errors and warnings of each document's log, with the first 12 of each."""
    rows = _events(spark, folder).withColumn("level", F.when(F.col("status") == "error", "error").when(F.col("attempt") > 1, "warning")).where("level is not null")
    return C.first_of_each(rows, ["doc_id", "level"], ["seq"], "call_id", 12).select("doc_id", "level", "n", F.array_join("first", ",").alias("first"))


DIAGNOSTICS = f"""
SELECT doc_id, level, count(*)::BIGINT AS n, array_to_string(list(call_id ORDER BY seq)[1:12], ',') AS first FROM (
  SELECT *, CASE WHEN status = 'error' THEN 'error' WHEN attempt > 1 THEN 'warning' END AS level FROM {_EVENTS}) WHERE level IS NOT NULL GROUP BY ALL
"""


def probe_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Probes of each target: counters grow with its events; what is new, and whether it came late."""
    history = _events(spark, folder).select("doc_id", "seq", "called_at", F.col("seq").alias("lines"), (F.col("seq") * 3 + F.col("attempt")).alias("calls"))
    rows = C.deltas(history, "doc_id", ["seq"], ["lines", "calls"], "called_at", 12_000)
    return rows.groupBy("doc_id").agg(F.count_if("stale").alias("stale"), F.max("new_lines").alias("most_lines"), F.sum("new_calls").alias("calls"))


DELTAS = f"""
SELECT doc_id, count(*) FILTER (WHERE gap >= 12000)::BIGINT AS stale, max(lines) AS most_lines, sum(calls)::BIGINT AS calls FROM (
  SELECT doc_id, seq - coalesce(lag(seq) OVER w, 0) AS lines, seq * 3 + attempt - coalesce(lag(seq * 3 + attempt) OVER w, 0) AS calls, epoch_us(called_at) / 1e6 - lag(epoch_us(called_at)) OVER w / 1e6 AS gap
  FROM {_EVENTS} WINDOW w AS (PARTITION BY doc_id ORDER BY seq)) GROUP BY doc_id
"""


def restart_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return C.restarts(_events(spark, folder), "doc_id", ["seq"], F.col("status") == "error", 4).select("doc_id", "seq", "attempt_no", "decision")


RESTARTS = f"""
SELECT doc_id, seq, n::BIGINT AS attempt_no, CASE WHEN n <= 4 THEN 'restart' ELSE 'exhausted' END AS decision FROM (
  SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY seq) AS n FROM (
    SELECT *, status = 'error' AND coalesce(lag(status) OVER (PARTITION BY doc_id ORDER BY seq), 'ok') <> 'error' AS new FROM {_EVENTS})) WHERE new
"""


def started_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """When the work of each completion began: orders complete, their lines' ship dates start."""
    done = R.frame(spark, folder, "SELECT o_custkey AS source, o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS completed_at FROM {orders}")
    starts = R.frame(spark, folder, "SELECT l_suppkey AS source, CAST(l_shipdate AS TIMESTAMP) AS started_at FROM {lineitem}")
    return C.started_bounds(done, starts)


BOUNDS = """
WITH c AS (SELECT o_custkey AS source, o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS done FROM orders),
t AS (SELECT source, id, done, row_number() OVER (PARTITION BY source ORDER BY done, id) AS k FROM c),
p AS (SELECT t.*, b.done AS before FROM t LEFT JOIN t b ON b.source = t.source AND b.k = t.k - 1),
s AS (SELECT DISTINCT l_suppkey AS source, CAST(l_shipdate AS TIMESTAMP) AS begun FROM lineitem)
SELECT p.source, p.id, min(s.begun) AS started_at FROM p LEFT JOIN s ON s.source = p.source AND s.begun <= p.done AND (p.before IS NULL OR s.begun > p.before) GROUP BY p.source, p.id
"""


def width_last(spark: SparkSession, folder: str) -> DataFrame:
    """The last value that a log gives for each document and column."""
    return _events(spark, folder).groupBy("doc_id", "stage").agg(F.max_by("seconds", "seq").alias("width"), F.count("*").alias("probes"))


WIDTHS = f"SELECT doc_id, stage, arg_max(seconds, seq) AS width, count(*)::BIGINT AS probes FROM {_EVENTS} GROUP BY ALL"

QUERIES = {
    "billing_backfill": (billing_backfill, BACKFILL),
    "page_status": (page_status, PAGE_STATUS),
    "job_observation": (job_observation, OBSERVATION),
    "evidence_union": (evidence_union, EVIDENCE),
    "calls_union": (calls_union, UNION_CALLS),
    "stage_progress": (stage_progress, PROGRESS),
    "queue_progress": (queue_progress, QUEUES),
    "sync_summary": (sync_summary, SYNC),
    "log_diagnostics": (log_diagnostics, DIAGNOSTICS),
    "probe_deltas": (probe_deltas, DELTAS),
    "restart_decisions": (restart_decisions, RESTARTS),
    "started_bounds": (started_bounds, BOUNDS),
    "width_last": (width_last, WIDTHS),
}
