"""Model calls, logs and probes of running jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _seconds(at: str) -> Column:
    return F.col(at).cast("timestamp").cast("double")


def latest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, *[f"_last.{c}" for c in rest])


def billing_backfill(wanted: DataFrame, finishes: DataFrame, order: list[str]) -> DataFrame:
    """``wanted`` (``id``, ``call_id``) with the tokens of each call's first finish event, and how many calls of an id have none."""
    first = finishes.groupBy("call_id").agg(F.min_by(F.struct("input_tokens", "output_tokens"), F.struct(*order)).alias("t"), F.lit(True).alias("found"))
    rows = wanted.join(first, "call_id", "left")
    return rows.groupBy("id").agg(F.count("*").alias("calls"), F.count_if(F.col("found").isNull()).alias("missing"), F.sum("t.input_tokens").alias("input_tokens"), F.sum("t.output_tokens").alias("output_tokens"))


def page_states(calls: DataFrame, keys: list[str]) -> DataFrame:
    """A page's state from the call that finished last: failed, retried or done; and its calls."""
    last = F.max_by(F.struct("status", "attempt", "stage"), F.struct("called_at", "call_id"))
    rows = calls.groupBy(*keys).agg(last.alias("l"), F.count("*").alias("calls"))
    state = F.when(F.col("l.status") == "error", "failed").when(F.col("l.attempt") > 1, "retried").otherwise("done")
    return rows.select(*keys, state.alias("state"), F.col("l.stage").alias("stage"), "calls")


def observation(calls: DataFrame, jobs: DataFrame, concurrency: int) -> DataFrame:
    """Totals of each document's calls, null if any is unknown, with the known part beside them, and the seconds that its remaining pages will take.

    ``jobs`` has ``doc_id`` and ``pages``; a page is done once a recognition of it succeeds.
    """
    ok = (F.col("stage") == "recognize") & (F.col("status") == "ok")
    rows = calls.groupBy("doc_id").agg(
        F.count("*").alias("calls"),
        F.when(F.count("input_tokens") == F.count("*"), F.sum("input_tokens")).alias("input_tokens"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("known_input_tokens"),
        F.count_if(ok).alias("done"),
        F.avg(F.when(ok, F.col("seconds"))).alias("mean_seconds"),
    )
    rows = jobs.join(rows, "doc_id", "left").withColumn("remaining", F.greatest(F.col("pages") - F.coalesce("done", F.lit(0)), F.lit(0)))
    return rows.withColumn("eta_seconds", F.col("mean_seconds") * F.col("remaining") / concurrency)


def last_attempt(events: DataFrame, key: str, order: list[str], started: Column) -> DataFrame:
    """The events since the last one that starts an attempt, with its number; events before any start are attempt 0."""
    by = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = events.withColumn("attempt_no", F.sum(F.when(started, 1).otherwise(0)).over(by))
    last = rows.groupBy(key).agg(F.max("attempt_no").alias("_last"))
    return rows.join(last, key).where(F.col("attempt_no") == F.col("_last")).drop("_last")


def first_of_each(rows: DataFrame, keys: list[str], order: list[str], value: str, most: int) -> DataFrame:
    """Count and the first ``most`` values of each key, in order; each task drops its later rows before they are shuffled."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = rows.select(*keys, *order, value).withColumn("_place", place).where(F.col("_place") <= most)
    first = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_place", value))).alias("_first"))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    same = [counts[k].eqNullSafe(first[k]) for k in keys]
    return counts.join(first, same).select(*[counts[k] for k in keys], "n", F.transform("_first", lambda x: x[value]).alias("first"))


def deltas(history: DataFrame, key: str, order: list[str], counters: list[str], at: str, stale_after: float) -> DataFrame:
    """What each probe adds to the one before it, and whether nothing was new for too long."""
    by = Window.partitionBy(key).orderBy(*order)
    rows = history.select("*", *[(F.col(c) - F.coalesce(F.lag(c).over(by), F.lit(0))).alias(f"new_{c}") for c in counters])
    gap = _seconds(at) - F.lag(_seconds(at)).over(by)
    return rows.withColumn("stale", F.coalesce(gap >= stale_after, F.lit(False)))


#: Alerts of a probe, in the order in which they count: fixed values of the record format.
ALERTS = ("oom", "non_api", "retries_exhausted")


def alert_kind(found: Column) -> Column:
    """The first alert that a list of findings holds."""
    out = F.lit(None).cast("string")
    for name in reversed(ALERTS):
        out = F.when(F.array_contains(found, name), name).otherwise(out)
    return out


def restarts(probes: DataFrame, key: str, order: list[str], down: Column, budget: int) -> DataFrame:
    """One row for each time a target goes down: its number, and whether a restart is within the budget."""
    by = Window.partitionBy(key).orderBy(*order)
    rows = probes.withColumn("_down", down).withColumn("_new", F.col("_down") & ~F.coalesce(F.lag("_down").over(by), F.lit(False)))
    rows = rows.withColumn("attempt_no", F.sum(F.col("_new").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.where("_new").withColumn("decision", F.when(F.col("attempt_no") <= budget, "restart").otherwise("exhausted")).drop("_down", "_new")


def started_bounds(completions: DataFrame, starts: DataFrame) -> DataFrame:
    """Each completion's first start since the same source's completion before it.

    ``completions`` has ``source``, ``id``, ``completed_at``; ``starts`` ``source`` and ``started_at``.
    Both are one time line of a source, so a window finds it without pairing them.
    """
    line = completions.select("source", "id", F.col("completed_at").alias("at"), F.lit(None).cast("timestamp").alias("started")).union(starts.select("source", F.lit(None).cast("long"), "started_at", "started_at"))
    by = Window.partitionBy("source").orderBy("at", F.col("id").isNotNull(), "id")
    rows = line.withColumn("_before", F.coalesce(F.sum(F.col("id").isNotNull().cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.groupBy("source", "_before").agg(F.max("id").alias("id"), F.min("started").alias("started_at")).where("id is not null").drop("_before")
