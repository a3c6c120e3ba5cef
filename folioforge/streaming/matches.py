"""Starts of calls matched with their ends, as a stream with bounded state.

Both sides have a watermark and an end comes within ``within`` of its start, so Spark
drops a start from its state once no end can come any more, and gives it out unmatched
then. Ends and starts later than ``late`` behind the newest rows of their side are
dropped; what the batch query over all rows tells of older starts is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matched(starts: DataFrame, ends: DataFrame, within: str, late: str = "0 seconds") -> DataFrame:
    """``starts`` (``call_id``, ``started_at``, others) with ``finished_at`` and ``ended`` of their ``ends`` (``call_id``, ``finished_at``), null if there is none in time.

    A call with several ends is there once for each; rows with a null id or time match nothing
    (a null time never leaves the stream).
    """
    starts = starts.withWatermark("started_at", late)
    ends = ends.select(F.col("call_id").alias("end_id"), "finished_at").withWatermark("finished_at", late)
    on = F.expr(f"call_id = end_id AND finished_at >= started_at AND finished_at <= started_at + INTERVAL {within}")
    return starts.join(ends, on, "left_outer").select(*starts.columns, "finished_at", F.col("end_id").isNotNull().alias("ended"))

