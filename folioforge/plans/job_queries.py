"""Queries over jobs, queues, partitions and batches, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import jobs as J
from folioforge.plans import adapters as R

_JOBS = R.duck(R.PIPELINE_JOB)
_NOW = "2000-01-01"


def _jobs(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, R.PIPELINE_JOB)


def state_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs(spark, folder).groupBy("stage", "status").agg(F.count("*").alias("n"))


STATE_COUNTS = f"SELECT stage, status, count(*)::BIGINT AS n FROM {_JOBS} GROUP BY stage, status"


def recent_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty newest jobs, a top-k report."""
    return _jobs(spark, folder).orderBy(F.desc("updated_at"), F.desc("id")).limit(20).select("id", "stage", "status", "updated_at")


RECENT = f"SELECT id, stage, status, updated_at FROM {_JOBS} ORDER BY updated_at DESC, id DESC LIMIT 20"


def events_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page of a job's events after a cursor, the feature being the limit."""
    rows = R.frame(spark, folder, R.CALL_EVENT)
    return rows.where("call_id > 1000").orderBy("call_id").limit(500).select("call_id", "doc_id", "event")


EVENTS_PAGE = f"SELECT call_id, doc_id, event FROM {R.duck(R.CALL_EVENT)} WHERE call_id > 1000 ORDER BY call_id LIMIT 500"


def claim_next(spark: SparkSession, folder: str) -> DataFrame:
    return J.claimable(_jobs(spark, folder), F.lit(_NOW).cast("timestamp"), 3).select("id", "source", "attempts")


_CLAIMABLE = f"SELECT * FROM {_JOBS} j WHERE status = 'retry' AND next_retry_at <= TIMESTAMP '{_NOW}' AND attempts < {{}} AND NOT EXISTS (SELECT 1 FROM {_JOBS} b WHERE b.status = 'running' AND b.source = j.source)"
CLAIM_NEXT = f"SELECT id, source, attempts FROM ({_CLAIMABLE.format(3)})"


def web_claim_next(spark: SparkSession, folder: str) -> DataFrame:
    return J.next_claims(_jobs(spark, folder), F.lit(_NOW).cast("timestamp"), 5, 10).select("id", "position")


WEB_CLAIM = f"SELECT id, position FROM ({_CLAIMABLE.format(5)}) ORDER BY position, id LIMIT 10"
_DELAYS = (180, 360, 720, 1440, 2880, 5760)


def retry_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs(spark, folder).select("id", J.retry_delay(F.col("attempts") * 2, _DELAYS).alias("delay"))


RETRY = f"SELECT id, ([{', '.join(map(str, _DELAYS))}])[attempts * 2 + 1]::INT AS delay FROM {_JOBS}"


def dispatch_units(spark: SparkSession, folder: str) -> DataFrame:
    """Sources all of whose jobs are completed: their queue may hand on."""
    return _jobs(spark, folder).groupBy("source").agg(F.count("*").cast("int").alias("jobs"), F.every(F.col("status") == "completed").alias("complete"))


DISPATCH = f"SELECT source, count(*)::INT AS jobs, bool_and(status = 'completed') AS complete FROM {_JOBS} GROUP BY source"


def lpt_plan(spark: SparkSession, folder: str) -> DataFrame:
    """A plan for each brand's parts over three workers."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    rows = parts.select(F.col("p_brand").alias("brand"), F.format_string("%08d.pdf", "p_partkey").alias("source"), F.col("p_size").cast("long").alias("pages"), (F.col("p_partkey") % 17 == 0).alias("pinned"))
    return J.assign(rows, 3, "brand").withColumn("sources", F.array_join("sources", ","))


def partition_cover(spark: SparkSession, folder: str) -> DataFrame:
    """How often each source is assigned: exactly once in a valid plan."""
    plan = lpt_plan(spark, folder)
    return plan.select("brand", F.explode(F.split("sources", ",")).alias("source")).where("source <> ''").groupBy("source").agg(F.count("*").alias("times"))


COVER = "SELECT printf('%08d.pdf', p_partkey) AS source, 1::BIGINT AS times FROM part"
#: Customers as batches of orders as files, with a job for most.
FILES = """
SELECT concat('B', CAST(c_custkey AS STRING)) AS code, CAST(o_orderkey % 4 AS STRING) AS unit, c_custkey % 29 = 0 AS skipped,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderkey % 7 = 0 THEN 'failed'
            WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 'running' ELSE 'pending' END AS job,
       o_orderkey % 6 <> 0 AS finished, o_orderkey % 10 <> 0 AND o_orderstatus = 'F' AS published
FROM {customer} JOIN {orders} ON c_custkey = o_custkey
"""


def batch_status(spark: SparkSession, folder: str) -> DataFrame:
    files = R.frame(spark, folder, FILES)
    return J.batch_status(files.withColumn("state", J.file_state(F.col("skipped"), F.col("job"), F.col("finished"), F.col("published"))))


BATCH_STATUS = f"""
WITH f AS (SELECT *, CASE WHEN skipped THEN 'skipped' WHEN job IS NOT NULL THEN CASE WHEN job = 'done' AND NOT (finished AND published) THEN 'review' ELSE job END
                          WHEN published THEN 'review' ELSE 'unstarted' END AS state FROM {R.duck(FILES)}),
g AS (SELECT code, count(*)::BIGINT AS total, {', '.join(f"count(*) FILTER (WHERE state = '{s}')::BIGINT AS {s}" for s in ('done', 'skipped', 'running', 'failed', 'pending', 'review'))},
             string_agg(DISTINCT unit, ',' ORDER BY unit) AS units FROM f GROUP BY code)
SELECT *, CASE WHEN skipped = total THEN '已排除' WHEN done = total THEN '已完成' WHEN running > 0 THEN '处理中' WHEN failed > 0 THEN '失败待处理'
               WHEN pending > 0 THEN '排队中' WHEN review > 0 THEN '待核验' WHEN done > 0 THEN '部分完成' ELSE '未开始' END AS status FROM g
"""

QUERIES = {
    "state_counts": (state_counts, STATE_COUNTS),
    "recent_jobs": (recent_jobs, RECENT),
    "events_page": (events_page, EVENTS_PAGE),
    "claim_next": (claim_next, CLAIM_NEXT),
    "web_claim_next": (web_claim_next, WEB_CLAIM),
    "retry_schedule": (retry_schedule, RETRY),
    "dispatch_units": (dispatch_units, DISPATCH),
    "lpt_plan": (lpt_plan, None),
    "partition_cover": (partition_cover, COVER),
    "batch_status": (batch_status, BATCH_STATUS),
}
