"""Restarts of watched targets as a stream with state and timers.

Each target has a small state: ``idle``, ``waiting`` (a restart is due), ``starting``
(it was begun), ``succeeded``, ``failed`` or ``limit`` (the budget is used up).
Observations are kept until the watermark has passed them, then taken in order of
time, so the outcome doesn't depend on how they came in; what is kept is bounded by
the watermark's delay. All that is known of a target is one value of state, read and
written once a batch, because each access is a call to another process and each row of a
list there is written on its own. Waiting and starting end by timers of event time. Notices go
out once each: the state that says so is saved with the batch that emits them.

A failure that calls for a restart takes one from the budget before anything is done,
and waits its delay. A start succeeds if another run is seen, running or ended well,
and fails if that run ended badly or none is seen in time. A changed run that nobody
asked for is a restart by hand: it counts, but needs no budget. Probes that went wrong
(``monitor_error``), repeated failures while a restart is under way, and rows with a
null time are ignored; rows later than the watermark are dropped by Spark; ties of time
go by ``seq``.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Spark runs some of this in processes beside the driver that get none of the files sent to executors: it goes there by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a probe tells of a target; ``run`` names the container's run, ``status`` is one of running, ended, broken, failing, monitor_error.
OBSERVATION = "target long, at timestamp, seq long, run string, status string"
#: The state store that timers and lists need.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_IDLE = ("idle", 0, 0, None, None)
_STATUSES = {"r": "running", "e": "ended", "b": "broken", "f": "failing"}


def _packed(at: Column, seq: Column, run: Column, status: Column) -> Column:
    """An observation as one text, as Python gets rows cell by cell; null without a time, other statuses are not told apart."""
    code = reduce(lambda other, c: F.when(status == _STATUSES[c], c).otherwise(other), _STATUSES, F.lit("-"))
    return F.concat(at, F.lit(" "), F.coalesce(seq.cast("string"), F.lit("")), F.lit(" "), code, F.coalesce(F.concat(F.lit("="), run), F.lit("")))


def _unpacked(told: str) -> tuple[int, int | None, str | None, str | None]:
    at, seq, rest = told.split(" ", 2)
    return int(at), int(seq) if seq else None, rest[2:] if len(rest) > 1 else None, _STATUSES.get(rest[0])


class Restarts(StatefulProcessor):
    def __init__(self, delays_ms: Sequence[int], timeout_ms: int) -> None:
        self.delays, self.timeout = tuple(delays_ms), timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "phase string, attempt int, due long, seen string, old string, kept binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [_unpacked(r["told"]) for r in rows if r["told"] is not None]
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, key, new: list[tuple], watermark: int) -> Iterator[Row]:
        *state, kept = self.state.get() or (*_IDLE, None)
        state, rows = tuple(state), pickle.loads(kept) if kept else []
        if new:
            rows = sorted(rows + new, key=lambda r: (r[0], r[1]))
        ready = [r for r in rows if r[0] // 1000 < watermark]
        later = rows[len(ready) :]
        notices: list[tuple[int, str, int]] = []
        for at, _, run, status in ready:
            state = self._timers(state, at // 1000, notices)
            state = self._observed(state, at // 1000, run, status, notices)
        state = self._timers(state, watermark - 1, notices)
        self.state.update((*state, pickle.dumps(later) if later else None))
        due = [later[0][0] // 1000 + 1] if later else []
        due += [state[2] + 1] if state[0] in ("waiting", "starting") else []
        if due:  # the first one sets the next
            self.handle.registerTimer(min(due))
        for attempt, phase, at in notices:
            yield Row(target=key[0], attempt=attempt, phase=phase, at_ms=at)

    def _timers(self, state: tuple, now: int, notices: list) -> tuple:
        phase, attempt, due, seen, old = state
        if phase == "waiting" and due <= now:
            notices.append((attempt, "starting", due))
            phase, due, old = "starting", due + self.timeout, seen
        if phase == "starting" and due <= now:
            notices.append((attempt, "failed", due))
            phase = "failed"
        return phase, attempt, due, seen, old

    def _observed(self, state: tuple, now: int, run: str | None, status: str, notices: list) -> tuple:
        phase, attempt, due, seen, old = state
        if status == "failing":
            if phase not in ("waiting", "starting") and attempt < len(self.delays):
                attempt, phase, due = attempt + 1, "waiting", now + self.delays[attempt]
                notices.append((attempt, "waiting", now))
            elif phase not in ("waiting", "starting", "limit"):
                phase = "limit"
                notices.append((attempt, "limit_reached", now))
        elif status in ("running", "ended", "broken") and run is not None:
            by_hand = phase in ("idle", "succeeded", "failed") and seen is not None and run != seen
            if by_hand:
                attempt, old = attempt + 1, seen
                notices.append((attempt, "starting", now))
            if by_hand or (phase == "starting" and run != old):
                phase = "failed" if status == "broken" else "succeeded"
                notices.append((attempt, phase, now))
            seen = run
        return phase, attempt, due, seen, old


def notices_of(observations: DataFrame, delays_ms: Sequence[int], timeout_ms: int, late: str = "0 seconds") -> DataFrame:
    """The stream of notices: ``target``, ``attempt``, ``phase`` and ``at``; ``delays_ms`` has one delay for each restart of the budget."""
    told = _packed(F.unix_micros("at"), F.col("seq"), F.col("run"), F.col("status"))
    rows = observations.select("target", "at", told.alias("told")).withWatermark("at", late)
    out = rows.groupBy("target").transformWithState(Restarts(delays_ms, timeout_ms), "target long, attempt int, phase string, at_ms long", "Append", "eventTime")
    return out.select("target", "attempt", "phase", F.timestamp_millis("at_ms").alias("at"))
