"""Job state, queues, partitions and batches."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import kept


def claimable(jobs: DataFrame, now: Column, max_attempts: int) -> DataFrame:
    """Jobs that may start: retries that are due, of attempts left, whose source runs no other job."""
    busy = jobs.where("status = 'running'").select("source").distinct()
    due = jobs.where((F.col("status") == "retry") & (F.col("next_retry_at") <= now) & (F.col("attempts") < max_attempts))
    return due.join(busy, "source", "left_anti")


def next_claims(jobs: DataFrame, now: Column, max_attempts: int = 5, limit: int = 1) -> DataFrame:
    """The claimable jobs of least position, then id."""
    return claimable(jobs, now, max_attempts).orderBy("position", "id").limit(limit)


#: The web queue's commands: status before, command, status after.
TRANSITIONS = (
    ("draft", "submit", "queued"), ("queued", "pause", "paused"), ("running", "pause", "pausing"), ("paused", "resume", "queued"),
    ("failed", "retry", "queued"), ("queued", "cancel", "cancelled"), ("paused", "cancel", "cancelled"), ("failed", "cancel", "cancelled"),
    ("running", "finish", "succeeded"), ("running", "fail", "failed"), ("pausing", "stop", "paused"),
)


def after_command(status: Column, command: Column, transitions: Sequence[tuple[str, str, str]] = TRANSITIONS) -> Column:
    """The status a command leads to, or null if the status doesn't allow it."""
    table = F.create_map(*[F.lit(x) for before, name, after in transitions for x in (f"{before} {name}", after)])
    return F.try_element_at(table, F.concat_ws(" ", status, command))


def retry_delay(attempt: Column, delays: Sequence[int]) -> Column:
    """Seconds to wait after the given attempt (from 0); null once attempts are used up."""
    return F.try_element_at(F.array(*[F.lit(d) for d in delays]), attempt.cast("int") + 1)


def assign(pages: DataFrame, workers: int, by: str) -> DataFrame:
    """Greedy assignment of each group's sources to workers: pinned ones to the first, then the largest to the least loaded.

    ``pages`` has the group column ``by``, ``source``, ``pages`` (whole numbers from 0, null
    counts as 0) and ``pinned``. Only a group's sizes and how many sources have each are
    folded; of sources of one size each takes the place of its rank among those that the
    fold gave out, so no list of sources is folded or held but a worker's own.
    """
    items = pages.select(F.col(by).alias("_by"), "source", F.coalesce("pages", F.lit(0)).cast("long").alias("size"), F.coalesce("pinned", F.lit(True)).alias("pinned"))
    runs = items.groupBy("_by", "pinned", "size").agg(F.count("*").alias("n"))
    kind = items.schema["_by"].dataType.simpleString()
    shares = runs.groupBy("_by").applyInPandas(lambda runs: _shares(workers, runs), f"_by {kind}, pinned boolean, size long, worker int, load long, files long, n long")
    shares = kept(shares, "shares")
    run = Window.partitionBy("_by", "pinned", "size")
    turn = shares.where("n > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j"))
    turn = turn.withColumn("k", F.row_number().over(run.orderBy(F.col("load") + F.col("j") * F.col("size"), F.col("files") + F.col("j"), "worker"))).select("_by", "pinned", "size", "k", "worker")
    mine = items.withColumn("k", F.row_number().over(run.orderBy("source")))
    same = mine["_by"].eqNullSafe(turn["_by"]) & (mine["pinned"] == turn["pinned"]) & (mine["size"] == turn["size"]) & (mine["k"] == turn["k"])
    lists = mine.join(turn, same).groupBy(mine["_by"], "worker").agg(F.sort_array(F.collect_list(F.struct("source")))["source"].alias("sources"))
    loads = shares.groupBy("_by", "worker").agg(F.sum(F.col("n") * F.col("size")).alias("pages"), F.sum("n").cast("int").alias("files"))
    none = F.array().cast("array<string>")
    whole = loads.join(lists, loads["_by"].eqNullSafe(lists["_by"]) & (loads["worker"] == lists["worker"]), "left")
    return whole.select(loads["_by"].alias(by), loads["worker"], "pages", "files", F.coalesce("sources", none).alias("sources"))


def _shares(workers: int, runs: pd.DataFrame) -> pd.DataFrame:
    """How many sources of each size of one group each worker gets, and its load before: the least loaded gets the next one."""
    heap, out = [(0, 0, w) for w in range(1, workers + 1)], []
    for pinned, size, n in runs.sort_values(["pinned", "size"], ascending=False)[["pinned", "size", "n"]].itertuples(index=False):
        before, got = list(heap), dict.fromkeys(range(1, workers + 1), 0)
        if pinned:
            heap = [(load + n * size, files + n, w) if w == 1 else (load, files, w) for load, files, w in heap]
            heapq.heapify(heap)
            got[1] = n
        else:
            for _ in range(n):
                load, files, w = heap[0]
                heapq.heapreplace(heap, (load + size, files + 1, w))
                got[w] += 1
        out += [(runs["_by"].iloc[0], pinned, size, w, load, files, got[w]) for load, files, w in before]
    return pd.DataFrame(out, columns=["_by", "pinned", "size", "worker", "load", "files", "n"])


#: Notes of a batch code, the ending of a skipped one and the century of two-digit years: fixed values of the record format.
NO_MONTH, NO_LINE, SHORT_YEAR = "编号年月待核对", "工艺及线编码待核对", "两位年份按20xx解析"
SKIPPED, CENTURY = "_skip", "20"


def batch_code(code: Column) -> Column:
    """The parts of a batch code, read from its end: three digits of sequence, two of the month, four or two of the year, and a prefix.

    A prefix is a letter and two digits (the batch), then a letter with at most one digit
    (the process) and perhaps two digits (the line). Only prefixes that end in P go with
    years of two digits.
    """
    clean = F.when(code.endswith(SKIPPED), F.left(code, F.length(code) - len(SKIPPED))).otherwise(code)
    body = F.regexp_replace(clean, r"-\d+\z", "")

    def cut(year_digits: int) -> tuple[Column, Column, Column, Column]:
        digits = year_digits + 5
        tail = F.right(body, F.lit(digits))
        head = F.left(body, F.greatest(F.length(body) - digits, F.lit(0)))
        return head, F.left(tail, F.lit(year_digits)), F.substring(tail, year_digits + 1, 2), F.right(tail, F.lit(3))

    def dated(parts: tuple[Column, Column, Column, Column]) -> Column:
        return F.concat(*parts[1:]).rlike(r"\A\d+\z") & parts[2].try_cast("int").between(1, 12)

    long, short = cut(4), cut(2)
    is_long = dated(long) & long[1].startswith(CENTURY) & long[0].rlike(r"\A[A-Z]\d{2}[A-Z0-9]*\z")
    is_short = ~is_long & dated(short) & short[0].rlike(r"\A[A-Z]\d{2}P\z")
    head, year, month, sequence = (F.when(is_long, x).when(is_short, y) for x, y in zip(long, short, strict=True))
    found = is_long | is_short
    rest = F.substring(head, 4, 100)
    known = F.coalesce(rest.rlike(r"\A[A-Z](\d|\d{2}|\d{3})?\z"), F.lit(False))
    line = F.when(F.length(rest) > 2, F.right(rest, F.lit(2))).otherwise("")
    notes = F.array_compact(F.array(F.when(~found, NO_MONTH), F.when(found & ~known, NO_LINE), F.when(is_short, SHORT_YEAR)))
    return F.struct(
        F.left(F.coalesce(head, clean), F.lit(3)).alias("batch"),
        F.when(known, F.left(rest, F.length(rest) - F.length(line))).otherwise("").alias("process"),
        F.when(known, line).otherwise("").alias("line"),
        F.concat(F.when(is_short, CENTURY).otherwise(""), year, F.lit("-"), month).alias("month"),
        F.coalesce(sequence, F.lit("")).alias("sequence"),
        F.array_join(notes, "; ").alias("notes"),
    )


#: Statuses of a batch are fixed values of the record format.
def file_state(skipped: Column, status: Column, finished: Column, published: Column) -> Column:
    """The state of a batch's file from its job and its publication."""
    return F.when(skipped, "skipped").when(status.isNotNull(), F.when((status == "done") & ~(finished & published), "review").otherwise(status)).when(published, "review").otherwise("unstarted")


def batch_status(files: DataFrame) -> DataFrame:
    """One row a batch ``code``: counts by state, its units, and the first status of the ladder that holds."""
    n = {s: F.count_if(F.col("state") == s) for s in ("done", "skipped", "running", "failed", "pending", "review")}
    rows = files.groupBy("code").agg(F.count("*").alias("total"), *[c.alias(s) for s, c in n.items()], F.array_join(F.array_sort(F.collect_set("unit")), ",").alias("units"))
    ladder = F.when(F.col("skipped") == F.col("total"), "已排除").when(F.col("done") == F.col("total"), "已完成")
    for state, name in (("running", "处理中"), ("failed", "失败待处理"), ("pending", "排队中"), ("review", "待核验"), ("done", "部分完成")):
        ladder = ladder.when(F.col(state) > 0, name)
    return rows.withColumn("status", ladder.otherwise("未开始"))
