"""Queries over decisions of the job store, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import state as S
from folioforge.plans import adapters as R

#: One row an appended event of a job: lines of an order, in their order.
JOB_EVENT = """
SELECT l_orderkey AS id, (l_linenumber * 1000000 + l_partkey) * 1000000 + CAST(floor(l_extendedprice * 10) AS BIGINT) % 1000000 AS place, CASE l_returnflag WHEN 'A' THEN 'complete' WHEN 'N' THEN 'fail' ELSE 'invalidate' END AS event,
       CASE WHEN l_returnflag = 'N' THEN repeat(concat('line ', CAST(l_partkey AS STRING), ';'), 1200) END AS error
FROM {lineitem}
"""


def job_states(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, R.PIPELINE_JOB).select("id", "status")
    return S.after_events(jobs, R.frame(spark, folder, JOB_EVENT), F.md5).select("id", "status", "after", F.col("error").alias("error_md5"))


JOB_STATES = f"""
WITH e AS (SELECT * FROM {R.duck(JOB_EVENT)}),
m AS (SELECT id, arg_max(event, place) FILTER (WHERE event <> 'invalidate') AS event, max(place) FILTER (WHERE event <> 'invalidate') AS place,
             max(place) FILTER (WHERE event = 'invalidate') AS undone, right(arg_max(error, place) FILTER (WHERE event = 'fail'), 8000) AS error FROM e GROUP BY id),
s AS (SELECT j.id, j.status, CASE m.event WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'retry' ELSE j.status END AS state, m.place, m.undone, m.error FROM {R.duck(R.PIPELINE_JOB)} j LEFT JOIN m ON m.id = j.id)
SELECT id, status, CASE WHEN state = 'completed' AND undone IS NOT NULL AND (place IS NULL OR undone > place) THEN 'retry' ELSE state END AS after, md5(error) AS error_md5 FROM s
"""


def jobs_recovered(spark: SparkSession, folder: str) -> DataFrame:
    return S.recovered(R.frame(spark, folder, R.PIPELINE_JOB)).groupBy("stage", "status").agg(F.count("*").alias("jobs"))


RECOVERED = f"SELECT stage, CASE status WHEN 'running' THEN 'retry' ELSE status END AS status, count(*)::BIGINT AS jobs FROM {R.duck(R.PIPELINE_JOB)} GROUP BY ALL"


def completed_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return S.latest_completed(R.frame(spark, folder, R.PIPELINE_JOB), ["stage", "source"], ["id", "attempts"])


METADATA = f"""
SELECT stage, source, id, attempts FROM (SELECT *, row_number() OVER (PARTITION BY stage, source ORDER BY updated_at DESC, id DESC) AS k FROM {R.duck(R.PIPELINE_JOB)} WHERE status = 'completed') WHERE k = 1
"""
#: One row a request of a submission, sent again by some clients, with another content by others.
REQUEST = "SELECT event_id AS seq, user_id * 100 + CAST(floor(value) AS BIGINT) % 40 AS request_id, md5(event_type) AS fingerprint, ts AS asked, event_type = 'error' AS failed, user_id FROM {events}"


def web_submissions(spark: SparkSession, folder: str) -> DataFrame:
    return S.submissions(R.frame(spark, folder, REQUEST), "request_id", ["seq"], "fingerprint").select("seq", "request_id", "outcome")


SUBMISSIONS = f"""
SELECT seq, request_id, CASE WHEN k = 1 THEN 'accepted' WHEN fingerprint = f THEN 'repeat' ELSE 'conflict' END AS outcome FROM (
  SELECT seq, request_id, fingerprint, row_number() OVER w AS k, first_value(fingerprint) OVER w AS f FROM {R.duck(REQUEST)} WINDOW w AS (PARTITION BY request_id ORDER BY seq))
"""


def page_budget(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.within_budget(R.frame(spark, folder, REQUEST), ["user_id", "fingerprint"], ["asked", "seq"], 3)
    return rows.groupBy("user_id", "fingerprint").agg(F.count_if("granted").alias("granted"), F.count_if(~F.col("granted")).alias("refused"))


BUDGET = f"SELECT user_id, fingerprint, least(count(*), 3)::BIGINT AS granted, greatest(count(*) - 3, 0)::BIGINT AS refused FROM {R.duck(REQUEST)} GROUP BY ALL"


#: One row a queue of a unit, in order.
QUEUE = """
SELECT c_nationkey AS unit, c_custkey AS position, c_name AS queue, c_acctbal > 1000 AS complete,
       CASE WHEN c_custkey % 3 = 0 THEN 'running' WHEN c_custkey % 3 = 1 THEN 'failed' ELSE 'idle' END AS state, c_acctbal > 8500 AS failed FROM {customer}
"""


def first_open_queues(spark: SparkSession, folder: str) -> DataFrame:
    return S.first_open_queue(R.frame(spark, folder, QUEUE), "unit", "position")


FIRST_OPEN = f"""
SELECT unit, count(*)::BIGINT AS queues, arg_min(queue, position) FILTER (WHERE NOT complete) AS queue,
       CASE arg_min(state, position) FILTER (WHERE NOT complete) WHEN 'running' THEN 'active' WHEN 'failed' THEN 'blocked' WHEN 'idle' THEN 'started' END AS state FROM {R.duck(QUEUE)} GROUP BY unit
"""


def sequential_queue(spark: SparkSession, folder: str) -> DataFrame:
    return S.run_in_order(R.frame(spark, folder, QUEUE).drop("state"), "unit", "position").select("unit", "position", "state")


SEQUENTIAL = f"""
SELECT unit, position, CASE WHEN coalesce(position > stop, false) THEN 'pending' WHEN failed THEN 'failed' ELSE 'done' END AS state FROM (
  SELECT *, min(position) FILTER (WHERE failed) OVER (PARTITION BY unit) AS stop FROM {R.duck(QUEUE)})
"""


def upgraded_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations as pages: a third have a candidate, of which those of even turns are valid."""
    pages = R.frame(spark, folder, "SELECT conv_id, turn, MIN(text) AS text FROM {conversations} GROUP BY conv_id, turn")
    candidates = pages.where("(conv_id + turn) % 3 = 0").select("conv_id", "turn", F.reverse("text").alias("text"), (F.col("turn") % 2 == 0).alias("valid"))
    out = S.chosen_pages(pages, candidates, ["conv_id", "turn"])
    return out.groupBy("conv_id", "source").agg(F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars"), F.min(F.md5("text")).alias("least_md5"))


UPGRADED = """
WITH p AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY ALL),
c AS (SELECT *, CASE WHEN (conv_id + turn) % 3 = 0 AND turn % 2 = 0 AND text IS NOT NULL THEN 'candidate' ELSE 'original' END AS source FROM p),
t AS (SELECT *, CASE source WHEN 'candidate' THEN reverse(text) ELSE text END AS out FROM c)
SELECT conv_id, source, count(*)::BIGINT AS pages, sum(length(out))::BIGINT AS chars, min(md5(out)) AS least_md5 FROM t GROUP BY ALL
"""


def resume_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The page at which each conversation resumes: after its last complete turn, or at the first."""
    rows = R.frame(spark, folder, "SELECT conv_id, turn, role FROM {conversations}")
    return rows.groupBy("conv_id").agg(F.coalesce(F.max(F.when(F.col("role") == "assistant", F.col("turn"))) + 1, F.min("turn")).alias("first_page"))


RESUME = "SELECT conv_id, coalesce(max(turn) FILTER (WHERE role = 'assistant') + 1, min(turn)) AS first_page FROM conversations GROUP BY conv_id"


def schedule_times(spark: SparkSession, folder: str) -> DataFrame:
    """Waiting times, readiness and age of each job."""
    jobs = R.frame(spark, folder, R.PIPELINE_JOB).withColumn("age", (F.col("position") % 4000).cast("double"))
    return jobs.select("id", S.backoff(F.col("attempts") + 1, 30, 240).alias("wait"), S.stable(F.lit(0.0), F.col("age"), F.when(F.col("attempts") > 2, F.col("age") - F.col("attempts") * 20.0), 3000, 75).alias("ready"), S.snapshot_status(F.when(F.col("attempts") > 0, F.col("age") / 40), 20).alias("view"))


SCHEDULE = f"""
SELECT id, least(240.0::DOUBLE, 30.0::DOUBLE * pow(2, attempts)) AS wait, (position % 4000) >= 3000 OR (attempts > 2 AND attempts * 20 >= 75) AS ready,
       CASE WHEN attempts = 0 THEN 'pending' WHEN (position % 4000) / 40.0 <= 60 THEN 'current' ELSE 'stale' END AS view FROM {R.duck(R.PIPELINE_JOB)}
"""

QUERIES = {
    "job_states": (job_states, JOB_STATES),
    "jobs_recovered": (jobs_recovered, RECOVERED),
    "completed_metadata": (completed_metadata, METADATA),
    "web_submissions": (web_submissions, SUBMISSIONS),
    "page_budget": (page_budget, BUDGET),
    "first_open_queues": (first_open_queues, FIRST_OPEN),
    "sequential_queue": (sequential_queue, SEQUENTIAL),
    "upgraded_pages": (upgraded_pages, UPGRADED),
    "resume_pages": (resume_pages, RESUME),
    "schedule_times": (schedule_times, SCHEDULE),
}
