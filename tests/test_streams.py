"""Streams with state against folds: order within a batch, several batches, late rows, timers, bounded state."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioforge.session import new_folder, ship
from folioforge.streaming import calls, matches, restarts, run

DAY = datetime(2024, 5, 1, tzinfo=UTC)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def told(spark, batches, delays, timeout, late):
    place, folder = new_folder(spark, "told"), new_folder(spark, "seen")
    for batch in batches:
        spark.createDataFrame([(t, DAY + timedelta(seconds=s), q, r, x) for t, s, q, r, x in batch], restarts.OBSERVATION).coalesce(1).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(restarts.OBSERVATION).parquet(folder)
        run.append_now(restarts.notices_of(rows, delays, timeout, late), place, conf=restarts.PROVIDER)
    out = run.appended(spark, place).select("target", "attempt", "phase", (F.unix_seconds("at") - int(DAY.timestamp())).alias("s"))
    return sorted(tuple(r) for r in out.collect())


class Handle:
    """State, timers and the calls that reach them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def registerTimer(self, timer):
        self.calls += 1
        self.timers.append(timer)

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_a_batch_reads_and_writes_a_targets_state_once(spark):
    rows = spark.createDataFrame([(1, DAY + timedelta(seconds=s), s, r, x) for s, r, x in [(5, "a=b c", "running"), (1, None, "failing"), (9, "", "ended"), (7, None, "odd"), (3, "z", None)]] + [(1, None, 0, "n", "running")], restarts.OBSERVATION)
    us = F.unix_micros("at")
    told = rows.select(restarts._packed(us, F.col("seq"), F.col("run"), F.col("status")).alias("told"), us.alias("us")).collect()
    zero = int(DAY.timestamp()) * 1000
    assert sorted(restarts._unpacked(r.told)[1:] for r in told if r.told) == [(1, None, "failing"), (3, "z", None), (5, "a=b c", "running"), (7, None, None), (9, "", "ended")]
    assert all((r.told is None) == (r.us is None) and (r.us is None or restarts._unpacked(r.told)[0] == r.us) for r in told)
    machine, handle = restarts.Restarts((2000,), 4000), Handle()
    machine.init(handle)
    handle.mark = 0
    assert list(machine.handleInputRows((1,), told, handle)) == [] and handle.calls == 3 and handle.timers == [zero + 1001]
    handle.mark = zero + 8000
    notices = [(r.attempt, r.phase, r.at_ms - zero) for r in machine.handleExpiredTimer((1,), handle, None)]
    assert notices == [(1, "waiting", 1000), (1, "starting", 3000), (1, "succeeded", 5000)] and handle.calls == 6 and handle.timers[1:] == [zero + 9001]


def test_a_restart_that_succeeds_and_one_that_times_out(spark):
    rows = [
        (1, 0, 1, "r1", "running"), (1, 10, 2, None, "failing"), (1, 15, 3, None, "failing"), (1, 50, 4, "r1", "running"), (1, 60, 5, "r2", "running"),
        (1, 100, 6, None, "failing"), (1, 500, 7, "r2", "running"), (1, 600, 8, "r3", "broken"), (1, 700, 9, None, "monitor_error"), (1, 710, 10, None, "failing"), (1, 720, 11, None, "failing"),
        (2, 5, 12, "x", "running"), (2, 9, 13, "y", "ended"), (2, 9, 14, "z", "broken"), (3, 9000, 15, None, "running"),
    ]
    expected = [
        (1, 1, "starting", 40), (1, 1, "succeeded", 60), (1, 1, "waiting", 10), (1, 2, "failed", 260), (1, 2, "starting", 160), (1, 2, "waiting", 100),
        (1, 3, "failed", 600), (1, 3, "limit_reached", 710), (1, 3, "starting", 600), (2, 1, "starting", 9), (2, 1, "succeeded", 9), (2, 2, "failed", 9), (2, 2, "starting", 9),
    ]
    assert told(spark, [rows], (30_000, 60_000), 100_000, "0 seconds") == expected
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    assert told(spark, [shuffled], (30_000, 60_000), 100_000, "0 seconds") == expected


def test_batches_within_the_delay_give_the_same_and_later_rows_are_dropped(spark):
    chance = random.Random(6)
    rows = [(chance.randrange(3), chance.randrange(4000), k, chance.choice([None, "a", "b"]), chance.choice(["failing", "running", "ended", "broken"])) for k in range(120)]
    rows += [(9, 4500, 999, None, "running")]
    rows.sort(key=lambda r: r[1])
    blocks = [rows[:50], rows[40:50] + rows[50:]]
    blocks[0] = [r for r in blocks[0] if r not in rows[40:50]]
    chance.shuffle(blocks[1])
    once = told(spark, [rows], (20_000,) * 9, 90_000, "10 minutes")
    assert told(spark, blocks, (20_000,) * 9, 90_000, "10 minutes") == once
    late = [(1, 1, 5000, "late", "broken"), (9, 9000, 5001, None, "running")]
    assert [r for r in told(spark, [rows, late], (20_000,) * 9, 90_000, "0 seconds") if r[3] < 4500] == told(spark, [rows], (20_000,) * 9, 90_000, "0 seconds")


def test_matches_and_late_rows(spark):
    start, end = "call_id long, started_at timestamp", "call_id long, finished_at timestamp"
    at = lambda s: DAY + timedelta(seconds=s)
    folders = new_folder(spark, "starts"), new_folder(spark, "ends")
    place = new_folder(spark, "matched")
    batches = [
        ([(1, at(0)), (2, at(5)), (3, at(10)), (None, at(3)), (4, at(100))], [(1, at(30)), (1, at(40)), (2, at(90)), (3, at(1)), (None, at(4)), (7, at(100))]),
        ([(5, at(20)), (6, at(500)), (8, at(900))], [(6, at(510)), (4, at(130)), (9, at(900))]),  # 5 is late, 4's end comes in time but late
        ([(10, at(5000))], [(10, at(5000))]),
    ]
    for starts, ends in batches:
        spark.createDataFrame(starts, start).coalesce(1).write.mode("append").parquet(folders[0])
        spark.createDataFrame(ends, end).coalesce(1).write.mode("append").parquet(folders[1])
        rows = matches.matched(spark.readStream.schema(start).parquet(folders[0]), spark.readStream.schema(end).parquet(folders[1]), "60 SECONDS", "10 seconds")
        run.append_now(rows, place)
    base = int(DAY.timestamp())
    out = [(r.call_id, r.s, r.e, r.ended) for r in run.appended(spark, place).select("call_id", (F.unix_seconds("started_at") - base).alias("s"), (F.unix_seconds("finished_at") - base).alias("e"), "ended").collect()]
    assert sorted(out, key=str) == sorted([(1, 0, 30, True), (1, 0, 40, True), (2, 5, None, False), (3, 10, None, False), (None, 3, None, False), (4, 100, 130, True), (6, 500, 510, True), (8, 900, None, False), (10, 5000, 5000, True)], key=str)


def test_ids_are_forgotten_within_their_bound(spark):
    """Repeats within the watermark count once; rows later than it are dropped, and old ids leave the state."""
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    row = lambda i, s, kind="view": (i, DAY + timedelta(seconds=s), 7, kind, 1.5)
    folder, place = new_folder(spark, "calls"), new_folder(spark, "snapshots")
    for batch in ([row(1, 0), row(1, 3), row(2, 5, "error")], [row(2, 9), row(3, 600)], [row(4, 2), row(5, 601), row(5, 601)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        calls.write_snapshots(calls.call_totals(spark.readStream.schema(schema).parquet(folder), "1 minute"), place)
    state = calls.read_snapshot(spark, place, ["user_id"]).collect()
    assert [(r.user_id, r.calls, r.errors, r.tokens, r.last_id) for r in state] == [(7, 4, 1, 600, 5)]
