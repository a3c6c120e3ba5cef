"""Queries over decisions that depend on the last accepted row; their DuckDB texts walk from one accepted row to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import calls as C
from folioforge.operators import chains as A
from folioforge.operators.jobs import TRANSITIONS, after_command
from folioforge.plans import adapters as R

#: One row a request for a name; few computations succeed, so that failures follow one another.
NAME_REQUEST = "SELECT event_id AS seq, user_id, ts AS asked, CAST(floor(value) AS BIGINT) % 25 = 0 AS ok FROM {events}"
_DAY = 86_400_000_000

_WALK = """
WITH RECURSIVE r AS ({rows}),
first AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY t, id) AS k FROM r),
a AS (
  SELECT {keys}, t, id, ok FROM first WHERE k = 1
  UNION ALL
  SELECT {keys}, t, id, ok FROM (
    SELECT r.*, row_number() OVER (PARTITION BY {r_keys} ORDER BY r.t, r.id) AS k FROM a JOIN r ON {same} AND r.t >= a.t + {wait} WHERE NOT a.ok) WHERE k = 1),
e AS (SELECT {keys}, max(CASE WHEN ok THEN t END) AS end_at, max(CASE WHEN ok THEN id END) AS end_id FROM a GROUP BY {keys}),
d AS (
  SELECT r.*, CASE WHEN a.id IS NOT NULL THEN 'attempt' WHEN (r.t, r.id) > (e.end_at, e.end_id) THEN 'done' ELSE 'waiting' END AS decision
  FROM r LEFT JOIN a ON {same} AND a.id = r.id JOIN e ON {of_end})
"""


def _walk(rows: str, keys: list[str], wait: int) -> str:
    same = lambda x: " AND ".join(f"{x}.{k} = r.{k}" for k in keys)
    return _WALK.format(rows=rows, keys=", ".join(keys), r_keys=", ".join(f"r.{k}" for k in keys), same=same("a"), of_end=same("e"), wait=wait)


def naming_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Each request's answer: from the cache once a name was computed, refused for a day after a failed computation."""
    rows = R.frame(spark, folder, NAME_REQUEST).withColumn("at", F.unix_micros(F.col("asked").cast("timestamp")))
    rows = A.attempts(rows, ["user_id"], "at", "seq", "ok", _DAY)
    answer = F.when(F.col("decision") == "done", "cache").when((F.col("decision") == "attempt") & F.col("ok"), "computed").otherwise("failed")
    return rows.select("seq", "user_id", "decision", answer.alias("answer"))


CACHE = (
    _walk(f"SELECT seq AS id, user_id, epoch_us(asked) AS t, ok FROM {R.duck(NAME_REQUEST)}", ["user_id"], _DAY)
    + "SELECT id AS seq, user_id, decision, CASE WHEN decision = 'done' THEN 'cache' WHEN decision = 'attempt' AND ok THEN 'computed' ELSE 'failed' END AS answer FROM d"
)


def alert_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of each document: sent at once if they differ from the one before, again a while after an attempt that failed."""
    found = F.array_compact(F.array(F.when(F.col("attempt") == 3, "retries_exhausted"), F.when(F.col("status") == "error", "oom"), F.when(F.col("input_tokens").isNull(), "non_api")))
    rows = R.frame(spark, folder, R.CALL_EVENT).withColumn("kind", C.alert_kind(found)).where("kind is not null").withColumn("at", F.unix_micros(F.col("called_at").cast("timestamp")))
    by = Window.partitionBy("doc_id").orderBy("at", "seq")
    rows = rows.withColumn("new", F.lag("kind").over(by).isNull() | (F.lag("kind").over(by) != F.col("kind")))
    rows = rows.withColumn("run", F.sum(F.col("new").cast("int")).over(by)).withColumn("sent", F.col("seq") % 4 == 0)
    rows = A.attempts(rows, ["doc_id", "run"], "at", "seq", "sent", _DAY)
    state = F.when(F.col("decision") == "done", "already_sent").when(F.col("decision") == "waiting", "retry_waiting").when(F.col("sent"), "sent").otherwise("send_failed")
    return rows.select("doc_id", "seq", "kind", state.alias("state"))


_ALERTS = f"""
SELECT *, sum(CASE WHEN before IS NULL OR before <> kind THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY t, id) AS run FROM (
  SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY t, id) AS before FROM (
    SELECT doc_id, seq AS id, epoch_us(called_at) AS t, seq % 4 = 0 AS ok, CASE WHEN status = 'error' THEN 'oom' WHEN input_tokens IS NULL THEN 'non_api' WHEN attempt = 3 THEN 'retries_exhausted' END AS kind FROM {R.duck(R.CALL_EVENT)})
  WHERE kind IS NOT NULL)
"""
ALERTS = (
    _walk(_ALERTS, ["doc_id", "run"], _DAY)
    + "SELECT doc_id, id AS seq, kind, CASE decision WHEN 'done' THEN 'already_sent' WHEN 'waiting' THEN 'retry_waiting' ELSE CASE WHEN ok THEN 'sent' ELSE 'send_failed' END END AS state FROM d"
)

#: Web jobs and the commands that clients sent for them, with the version that each client had seen.
WEB_JOB = "SELECT c_custkey AS key, CAST(c_custkey % 3 AS BIGINT) AS version, CASE WHEN c_acctbal < 2000 THEN 'draft' WHEN c_acctbal < 6000 THEN 'queued' ELSE 'running' END AS status FROM {customer}"
COMMAND = """
SELECT user_id AS key, event_id AS place, CAST(floor(value) AS BIGINT) % 7 AS expected,
       CASE event_id % 8 WHEN 0 THEN 'submit' WHEN 1 THEN 'pause' WHEN 2 THEN 'resume' WHEN 3 THEN 'retry' WHEN 4 THEN 'cancel' WHEN 5 THEN 'finish' WHEN 6 THEN 'fail' ELSE 'stop' END AS action
FROM {events}
"""
#: Changes of any field of a job, sent by clients that have seen a version.
PATCH = "SELECT o_custkey AS key, o_orderkey AS place, CAST(floor(o_totalprice) AS BIGINT) % 5 AS expected, o_orderpriority AS action FROM {orders}"


def command_versions(spark: SparkSession, folder: str) -> DataFrame:
    return A.versioned(R.frame(spark, folder, WEB_JOB), R.frame(spark, folder, COMMAND), TRANSITIONS)


def patch_versions(spark: SparkSession, folder: str) -> DataFrame:
    return A.versioned(R.frame(spark, folder, WEB_JOB), R.frame(spark, folder, PATCH))


_FOLD = """
WITH RECURSIVE c AS ({changes}), t(before, action, after) AS ({table}),
a AS (
  SELECT key, version, status, CAST(-1 AS BIGINT) AS place FROM {objects}
  UNION ALL
  SELECT key, version, status, place FROM (
    SELECT a.key, a.version + 1 AS version, {after} AS status, c.place, row_number() OVER (PARTITION BY a.key ORDER BY c.place) AS k
    FROM a JOIN c ON c.key = a.key AND c.expected = a.version AND c.place > a.place {allowed}) WHERE k = 1)
SELECT c.key, c.place, c.expected, c.action, a.key IS NOT NULL AS accepted, a.version, a.status FROM c LEFT JOIN a ON a.key = c.key AND a.place = c.place
"""
_TABLE = "VALUES " + ", ".join(str(t) for t in TRANSITIONS)
COMMANDS = _FOLD.format(changes=R.duck(COMMAND), table=_TABLE, objects=R.duck(WEB_JOB), after="t.after", allowed="JOIN t ON t.before = a.status AND t.action = c.action")
PATCHES = _FOLD.format(changes=R.duck(PATCH), table=_TABLE, objects=R.duck(WEB_JOB), after="a.status", allowed="")

#: Orders as fields of a few pages, in order, with the size of what is sent for each.
FIELD = "SELECT o_orderpriority AS page, o_orderkey AS place, CAST(floor(o_totalprice) AS BIGINT) % 5000 AS size FROM {orders}"
_BUDGET = 12_000


def packed_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Which request each field goes into, in order, under a budget."""
    return A.packed(R.frame(spark, folder, FIELD), ["page"], "place", "size", _BUDGET)


PACKED = f"""
WITH RECURSIVE f AS (SELECT *, sum(size) OVER (PARTITION BY page ORDER BY place) AS ending FROM {R.duck(FIELD)}),
a AS (
  SELECT page, min(place) AS place, CAST(0 AS HUGEINT) AS begun, CAST(1 AS BIGINT) AS request FROM f GROUP BY page
  UNION ALL
  SELECT page, place, begun, request FROM (
    SELECT f.page, f.place, f.ending - f.size AS begun, a.request + 1 AS request, row_number() OVER (PARTITION BY f.page ORDER BY f.place) AS k
    FROM a JOIN f ON f.page = a.page AND f.place > a.place AND f.ending > a.begun + {_BUDGET}) WHERE k = 1)
SELECT f.page, f.place, f.size, max(a.request) AS request FROM f JOIN a ON a.page = f.page AND a.place <= f.place GROUP BY ALL
"""



def command_transitions(spark: SparkSession, folder: str) -> DataFrame:
    """What each command would make of its job as it stands, whatever versions say."""
    pairs = R.frame(spark, folder, COMMAND).join(R.frame(spark, folder, WEB_JOB).select("key", "status"), "key")
    return pairs.withColumn("after", after_command(F.col("status"), F.col("action"))).groupBy("status", "action", "after").agg(F.count("*").alias("n"))


TRANSITION_COUNTS = f"""
SELECT j.status, c.action, t.after, count(*)::BIGINT AS n FROM {R.duck(COMMAND)} c JOIN {R.duck(WEB_JOB)} j ON j.key = c.key LEFT JOIN ({_TABLE}) AS t(before, action, after) ON t.before = j.status AND t.action = c.action GROUP BY ALL
"""

QUERIES = {
    "command_transitions": (command_transitions, TRANSITION_COUNTS),
    "packed_requests": (packed_requests, PACKED),
    "naming_cache": (naming_cache, CACHE),
    "alert_kinds": (alert_kinds, ALERTS),
    "command_versions": (command_versions, COMMANDS),
    "patch_versions": (patch_versions, PATCHES),
}
