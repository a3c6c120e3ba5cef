"""Queries that run as streams over the tables, each with the DuckDB text of its batch equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.plans import adapters as R
from folioforge.session import new_folder, ship, table
from folioforge.sources import logs, published
from folioforge.streaming import matches, restarts, run

_LINE = "event_id long, user_id long, event_type string, value double"


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as log files of JSON lines, read back as growing logs in two runs; totals of each document's calls."""
    ship(spark)
    place = new_folder(spark, "logs")
    table(spark, folder, "events").select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value")).write.text(f"{place}/in")
    for _ in range(2):
        logs.append_lines(logs.lines_of(spark, f"{place}/in", "part-*"), f"{place}/out")
    calls = logs.current_lines(spark, f"{place}/out").select(F.from_json("line", _LINE).alias("e")).select("e.*")
    return calls.groupBy("user_id").agg(F.count("*").alias("calls"), F.count_if(F.col("event_type") == "error").alias("errors"), F.sum(F.floor(F.col("value") * 100).cast("long")).alias("tokens"), F.max("event_id").alias("last_id"))


LOGS = """
SELECT user_id, count(*)::BIGINT AS calls, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS errors, sum(floor(value * 100)::BIGINT)::BIGINT AS tokens, max(event_id) AS last_id FROM events GROUP BY user_id
"""

#: Delays of the restarts that the budget allows, and how long a start may take, in milliseconds.
_HOUR = 3_600_000
DELAYS = (2 * _HOUR, 8 * _HOUR, 16 * _HOUR, 24 * _HOUR)
TIMEOUT = 12 * _HOUR
OBSERVED = """
SELECT user_id AS target, ts AS at, event_id AS seq,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(CAST(floor(event_id / 900) AS BIGINT) * 2 + CASE WHEN CAST(floor(value) AS BIGINT) % 9 = 0 THEN 1 ELSE 0 END AS STRING) END AS run,
       CASE WHEN event_id % 13 = 5 THEN 'monitor_error' WHEN event_type = 'error' THEN 'failing' WHEN event_type = 'signup' THEN 'broken' WHEN event_type = 'purchase' THEN 'ended' ELSE 'running' END AS status
FROM {events}
"""


def restart_stream(spark: SparkSession, folder: str) -> DataFrame:
    """What is told of each target's restarts, by a stream with timers."""
    ship(spark)
    place = new_folder(spark, "restarts")
    rows = R.frame(spark, folder, OBSERVED, events=run.stream_of(spark, folder, "events", ("ts",)))
    run.append_now(restarts.notices_of(rows, DELAYS, TIMEOUT), place, conf=restarts.PROVIDER)
    return run.appended(spark, place)


#: A fold over each target's observations, one step a row; a last row at the watermark lets timers end.
_MACHINE = f"""
WITH RECURSIVE o AS (SELECT target, epoch_us("at") // 1000 AS t, seq, run, status FROM {{observed}}),
w AS (SELECT max(t) AS mark FROM o),
l AS (
  SELECT target, t, seq, run, status FROM o, w WHERE t < mark
  UNION ALL SELECT DISTINCT target, mark - 1, CAST(9223372036854775807 AS BIGINT), NULL, 'end' FROM o, w),
n AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY t, seq) AS k FROM l),
m AS (
  SELECT target, CAST(0 AS BIGINT) AS k, 'idle' AS phase, 0 AS attempt, CAST(0 AS BIGINT) AS due, CAST(NULL AS VARCHAR) AS seen, CAST(NULL AS VARCHAR) AS old,
         CAST([] AS STRUCT(attempt INTEGER, phase VARCHAR, t BIGINT)[]) AS told
  FROM n GROUP BY target
  UNION ALL
  SELECT target, k, CASE WHEN reserve THEN 'waiting' WHEN spent THEN 'limit' WHEN judge AND status = 'broken' THEN 'failed' WHEN judge THEN 'succeeded' ELSE phase END,
         CASE WHEN reserve OR hand THEN attempt + 1 ELSE attempt END, CASE WHEN reserve THEN t + ([{', '.join(map(str, DELAYS))}])[attempt + 1] ELSE due END,
         CASE WHEN live THEN run ELSE seen END, CASE WHEN hand THEN seen ELSE old END,
         list_filter(told || [
           {{{{'attempt': attempt + 1, 'phase': CASE WHEN reserve THEN 'waiting' WHEN hand THEN 'starting' END, 't': t}}}},
           {{{{'attempt': attempt, 'phase': CASE WHEN spent THEN 'limit_reached' END, 't': t}}}},
           {{{{'attempt': CASE WHEN hand THEN attempt + 1 ELSE attempt END, 'phase': CASE WHEN judge AND status = 'broken' THEN 'failed' WHEN judge THEN 'succeeded' END, 't': t}}}}], lambda x: x.phase IS NOT NULL)
  FROM (
    SELECT *, hand OR (live AND phase = 'starting' AND run IS DISTINCT FROM old) AS judge FROM (
      SELECT *, status = 'failing' AND phase NOT IN ('waiting', 'starting') AND attempt < {len(DELAYS)} AS reserve,
             status = 'failing' AND phase NOT IN ('waiting', 'starting', 'limit') AND attempt >= {len(DELAYS)} AS spent,
             live AND phase IN ('idle', 'succeeded', 'failed') AND seen IS NOT NULL AND run <> seen AS hand
      FROM (
        SELECT target, k, t, run, status, coalesce(status IN ('running', 'ended', 'broken') AND run IS NOT NULL, false) AS live, attempt, seen, old, due,
               CASE WHEN late THEN 'failed' ELSE phase END AS phase,
               CASE WHEN late THEN told || [{{{{'attempt': attempt, 'phase': 'failed', 't': due}}}}] ELSE told END AS told
        FROM (
          SELECT *, phase = 'starting' AND due <= t AS late FROM (
            SELECT target, k, t, run, status, attempt, seen, CASE WHEN begun THEN seen ELSE old END AS old, CASE WHEN begun THEN due + {TIMEOUT} ELSE due END AS due,
                   CASE WHEN begun THEN 'starting' ELSE phase END AS phase,
                   CASE WHEN begun THEN [{{{{'attempt': attempt, 'phase': 'starting', 't': due}}}}] ELSE [] END AS told
            FROM (SELECT n.*, m.phase, m.attempt, m.due, m.seen, m.old, m.phase = 'waiting' AND m.due <= n.t AS begun FROM m JOIN n ON n.target = m.target AND n.k = m.k + 1)))))))
SELECT target, x.attempt AS attempt, x.phase AS phase, make_timestamp(x.t * 1000) AS "at" FROM (SELECT target, unnest(told) AS x FROM m)
"""
RESTARTS = _MACHINE.format(observed=R.duck(OBSERVED))

#: Calls begin as views and clicks, and end as purchases of an earlier event's id.
START = "SELECT event_id AS call_id, user_id AS doc_id, ts AS started_at FROM {events} WHERE event_type IN ('view', 'click')"
END = "SELECT event_id - CAST(floor(value) AS BIGINT) % 40 AS call_id, ts AS finished_at FROM {events} WHERE event_type = 'purchase'"


def start_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Starts with their ends, and those that nothing ended within two hours, as a stream gives them out."""
    place = new_folder(spark, "matches")
    starts, ends = (R.frame(spark, folder, sql, events=run.stream_of(spark, folder, "events", ("ts",))) for sql in (START, END))
    run.append_now(matches.matched(starts, ends, "2 HOURS", "1 hour"), place)
    return run.appended(spark, place)


MATCHES = f"""
WITH s AS (SELECT * FROM {R.duck(START)}), e AS (SELECT * FROM {R.duck(END)}),
w AS (SELECT date_trunc('millisecond', least((SELECT max(started_at) FROM s), (SELECT max(finished_at) FROM e))) - INTERVAL 1 HOUR AS mark)
SELECT s.call_id, s.doc_id, s.started_at, e.finished_at, e.call_id IS NOT NULL AS ended
FROM s LEFT JOIN e ON e.call_id = s.call_id AND e.finished_at >= s.started_at AND e.finished_at <= s.started_at + INTERVAL 2 HOURS, w
WHERE e.call_id IS NOT NULL OR s.started_at + INTERVAL 2 HOURS < mark
"""



def published_days(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows published a year at a time, one year twice; what readers see of them."""
    ship(spark)
    place = new_folder(spark, "published")
    days = R.frame(spark, folder, DAYS)
    years = sorted(r.y for r in days.select("y").distinct().collect())  # as many as the calendar has
    for year in [*years, *years[:1]]:
        published.publish(days.where(F.col("y") == year), place, f"{year}")
    return published.published(spark, place, days.schema).select("day", "documents", "pages")


DAYS = "SELECT day, CAST(year(day) AS INT) AS y, COUNT(*) AS documents, SUM(source_pages) AS pages FROM (" + R.COMPLETION + ") GROUP BY day, year(day)"
DAYS_SQL = f"SELECT day, count(*)::BIGINT AS documents, sum(source_pages)::BIGINT AS pages FROM {R.duck(R.COMPLETION)} GROUP BY day"

QUERIES = {
    "published_days": (published_days, DAYS_SQL),
    "log_stream": (log_stream, LOGS),
    "restart_stream": (restart_stream, RESTARTS),
    "start_matches": (start_matches, MATCHES),
}
