"""Decisions of the job store as relations: what a log of events makes of jobs, and which request wins.

Every function is a query over tables of jobs, events or requests; none changes a table in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import kept

ERROR_CHARS = 8000


def after_events(jobs: DataFrame, events: DataFrame, error: Callable[[Column], Column] | None = None) -> DataFrame:
    """``jobs`` (``id``, ``status``) after appended ``events`` (``id``, ``place``, ``event``, ``error``).

    ``complete`` and ``fail`` set a job to completed or retry, whatever it was;
    ``invalidate`` turns a completed job to retry. So the last complete or fail counts, and
    any invalidate after it. Adds ``after`` and the end of the last failure's ``error``.
    Places are unique within a job; only these are aggregated, the error of the place that
    won is fetched by them. ``error`` is what to make of such an end, like a digest, before
    it is moved; errors are cut before that too.
    """
    last = lambda event: F.max(F.when(F.col("event") == event, F.col("place"))).alias(event)
    places = events.groupBy("id").agg(last("complete"), last("fail"), last("invalidate"))
    none = F.lit(-(2**63))
    done, failed, undone = (F.coalesce(c, none) for c in ("complete", "fail", "invalidate"))
    places = kept(places, "places")
    rows = jobs.join(places, "id", "left").join(_errors(events, places, error or (lambda end: end)), "id", "left")
    state = F.when(done > failed, "completed").when(failed > done, "retry").otherwise(F.col("status"))
    undo = (state == "completed") & F.col("invalidate").isNotNull() & (undone > F.greatest(done, failed))
    return rows.select(*[jobs[c] for c in jobs.columns], F.when(undo, "retry").otherwise(state).alias("after"), "error")


def _errors(events: DataFrame, places: DataFrame, error: Callable[[Column], Column]) -> DataFrame:
    """``id`` and what ``error`` makes of the end of the error of each job's last failure; no more of an error is shuffled."""
    last = places.where(F.col("fail").isNotNull()).select(F.col("id").alias("_id"), F.col("fail").alias("_place"))
    ends = events.where("event = 'fail'").select("id", "place", error(F.right("error", F.lit(ERROR_CHARS))).alias("error"))
    return ends.join(last, (F.col("id") == F.col("_id")) & (F.col("place") == F.col("_place"))).select("id", "error")


def recovered(jobs: DataFrame) -> DataFrame:
    """Jobs whose run was interrupted go back to retry."""
    return jobs.withColumn("status", F.when(F.col("status") == "running", "retry").otherwise(F.col("status")))


def latest_completed(jobs: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The newest completed job of each key, for lookups by stage, source and fingerprint."""
    return jobs.where("status = 'completed'").groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct("updated_at", "id")).alias("m")).select(*keys, *[f"m.{c}" for c in columns])


def submissions(requests: DataFrame, key: str, order: list[str], fingerprint: str) -> DataFrame:
    """Adds ``outcome``: the first request of a key is accepted, equal ones repeat it, others conflict with it."""
    first = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = requests.withColumn("_first", F.first(fingerprint).over(first)).withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return rows.withColumn("outcome", F.when(F.col("_place") == 1, "accepted").when(F.col(fingerprint).eqNullSafe(F.col("_first")), "repeat").otherwise("conflict")).drop("_first", "_place")


def within_budget(requests: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """Adds ``granted``: the first ``limit`` requests of each key."""
    return requests.withColumn("granted", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) <= limit)


def first_open_queue(queues: DataFrame, unit: str, position: str) -> DataFrame:
    """For each unit its first queue that is not complete: active if it runs, blocked if it failed, else to be started; null if none is left."""
    open_one = F.when(~F.col("complete"), F.struct(position, "queue", "state"))
    rows = queues.groupBy(unit).agg(F.min(open_one).alias("q"), F.count("*").alias("queues"))
    state = F.when(F.col("q.state") == "running", "active").when(F.col("q.state") == "failed", "blocked").when(F.col("q").isNotNull(), "started")
    return rows.select(unit, "queues", F.col("q.queue").alias("queue"), state.alias("state"))


def run_in_order(jobs: DataFrame, queue: str, position: str) -> DataFrame:
    """Adds ``state``: jobs run in order until the first that fails; later ones stay pending."""
    before = Window.partitionBy(queue).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(F.col("failed").cast("int")).over(before), F.lit(0)) == 1
    return jobs.withColumn("state", F.when(stopped, "pending").when(F.col("failed"), "failed").otherwise("done"))


def chosen_pages(pages: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Each page's valid candidate, or the page as it was; ``source`` tells which."""
    valid = candidates.where("valid").select(*keys, F.col("text").alias("_candidate"))
    rows = pages.join(valid, keys, "left")
    return rows.withColumn("source", F.when(F.col("_candidate").isNull(), "original").otherwise("candidate")).withColumn("text", F.coalesce("_candidate", "text")).drop("_candidate")


def backoff(attempt: Column, base: float, most: float) -> Column:
    """Seconds to wait after the ``attempt``-th failure, doubling up to ``most``."""
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1))


def stable(modified: Column, now: Column, unchanged_since: Column, old_enough: float, quiet: float) -> Column:
    """Whether a file may be read: it is old enough, or unchanged for ``quiet`` seconds."""
    return ((now - modified) >= old_enough) | F.coalesce((now - unchanged_since) >= quiet, F.lit(False))


def snapshot_status(age: Column, poll: float) -> Column:
    """Whether a view is pending (none yet), current or stale, by its age and the polling interval."""
    return F.when(age.isNull(), "pending").when(age <= max(10.0, 3 * poll), "current").otherwise("stale")
