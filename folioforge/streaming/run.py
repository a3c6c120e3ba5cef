"""Running a stream over what is there now, into a table that readers can trust."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_now(rows: DataFrame, path: str, mode: str = "append", conf: dict[str, str] | None = None) -> None:
    """Adds the stream's new rows to the table at ``path``; a batch that runs twice writes the same folder."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id:08d}")

    spark = rows.sparkSession
    before = {k: spark.conf.get(k, None) for k in conf or {}}
    for key, value in (conf or {}).items():
        spark.conf.set(key, value)
    try:
        rows.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(append).trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("batch")


def stream_of(spark: SparkSession, folder: str, name: str, times: tuple[str, ...] = (), files_a_batch: int = 64) -> DataFrame:
    """The rows of a table's files as they come, with the columns ``times`` as instants."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(f"{folder}/{name}.[p]arquet")
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else rows
