"""States of jobs after their events: whole errors of failures."""

import hashlib

from pyspark.sql import functions as F

from folioforge.operators import state
from folioforge.plans import adapters, state_queries

FOLDER = "/root/testdata/sf0.01"


def test_errors_of_1200_lines(spark):
    events = [(r.id, r.place, r.event, r.l_partkey) for r in adapters.frame(spark, FOLDER, state_queries.JOB_EVENT.replace("FROM", ", l_partkey FROM")).select("id", "place", "event", "l_partkey").collect()]
    last = {}
    for job, place, event, part in events:
        if event == "fail" and (job not in last or place > last[job][0]):
            last[job] = (place, part)
    found = {r.id: r.error_md5 for r in state_queries.job_states(spark, FOLDER).collect()}
    assert found == {job: hashlib.md5((f"line {last[job][1]};" * 1200)[-8000:].encode()).hexdigest() if job in last else None for job in found} and last


def test_only_digests_of_errors_are_moved(spark):
    jobs = spark.createDataFrame([(1, "running"), (2, "retry")], "id long, status string")
    events = spark.createDataFrame([(1, 1, "fail", "a" * 9000), (1, 2, "fail", "b" * 9000 + "é"), (1, 3, "complete", "c"), (2, 1, "fail", None)], "id long, place long, event string, error string")
    whole = {r.id: r.error for r in state.after_events(jobs, events).collect()}
    assert whole == {1: "b" * 7999 + "é", 2: None}
    moved = {r.id: (r.after, r.error) for r in state.after_events(jobs, events, F.md5).collect()}
    assert moved == {1: ("completed", hashlib.md5(whole[1].encode()).hexdigest()), 2: ("retry", None)}
