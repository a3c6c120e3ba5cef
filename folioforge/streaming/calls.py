"""Model calls as a stream: state survives in the checkpoint, and a snapshot of it is written after each batch.

A batch query over all events is authoritative; the stream gives the same final state
while it reads only what is new. Event ids are kept without a time limit, as nothing bounds
how late an event comes; ``within`` bounds them where that is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, name: str = "events", files_a_batch: int = 64) -> DataFrame:
    """The rows of a table's files as they come; a pattern as path lets the table be one file or a folder of them."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(f"{folder}/{name}.[p]arquet")


def call_totals(events: DataFrame, within: str | None = None) -> DataFrame:
    """Totals of each document's calls, each event id counted once."""
    once = events.withWatermark("ts", within).dropDuplicatesWithinWatermark(["event_id"]) if within else events.dropDuplicates(["event_id"])
    return once.groupBy("user_id").agg(F.count("*").alias("calls"), F.count_if(F.col("event_type") == "error").alias("errors"), F.sum(F.floor(F.col("value") * 100)).alias("tokens"), F.max("event_id").alias("last_id"))


def latest_calls(events: DataFrame) -> DataFrame:
    """The last event of each document and kind, by id."""
    return events.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("value"), F.max("event_id").alias("event_id"))


def write_snapshots(state: DataFrame, path: str) -> None:
    """Runs the stream over what is there now; each batch adds the keys that changed, so a reader never sees half of one."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id:08d}")

    query = state.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint").foreachBatch(append).trigger(availableNow=True).start()
    query.awaitTermination()


def read_snapshot(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The latest state of every key; a batch that ran twice is there once, as it writes the same folder."""
    changes = spark.read.parquet(f"{path}/changes").drop("batch")
    rest = [c for c in changes.columns if c not in (*keys, "batch_id")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_last")).select(*keys, *[f"_last.{c}" for c in rest])
