"""What a stage has done since its last attempt began, as sets of pages kept by a stream.

Each batch adds, per document, the different pages of each kind that came after its
last reset, and the place of that reset. Such rows merge in any grouping: those before a
later reset are void, the others are united. They are rows of a few numbers, so what a
task holds follows the pages that were seen, not the numbers that pages could have. A
document's events come in the order of ``seq`` over batches, in any order within one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def delta(events: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row a document, kind and page of ``events`` (``doc``, ``seq``, ``kind``, ``page``); kind ``reset`` begins an attempt.

    A null page is of no kind, other kinds have no page; rows with a null document or place are dropped.
    """
    rows = events.dropna(subset=["doc", "seq"])
    resets = rows.where("kind = 'reset'").groupBy("doc").agg(F.max("seq").alias("reset"), F.count("*").alias("resets"))
    rows = rows.join(resets, "doc", "left").where("reset is null or seq >= reset")
    counts = F.col("kind").isin(*kinds) & F.col("page").isNotNull()
    rows = rows.select("doc", "seq", "reset", "resets", F.when(counts, F.col("kind")).alias("kind"), F.when(counts, F.col("page")).alias("page"))
    return rows.groupBy("doc", "kind", "page").agg(F.max("reset").alias("reset"), F.max("resets").alias("resets"), F.max("seq").alias("last"))


def append_progress(events: DataFrame, kinds: Sequence[str], path: str) -> None:
    """Runs the stream over what is there now; a batch that runs twice writes the same folder."""

    def append(batch: DataFrame, batch_id: int) -> None:
        delta(batch, kinds).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/deltas/batch={batch_id:08d}")

    events.writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(append).trigger(availableNow=True).start().awaitTermination()


def progress(spark: SparkSession, path: str, kinds: Sequence[str]) -> DataFrame:
    """``doc``, ``attempts`` (resets), ``last`` (place of its last event) and the number of pages of each kind in the last attempt."""
    rows = spark.read.parquet(f"{path}/deltas").drop("batch")
    # A document's rows of one batch repeat its resets.
    begun = rows.groupBy("doc", "batch_id").agg(F.max("reset").alias("reset"), F.max("resets").alias("resets"), F.max("last").alias("last"))
    begun = begun.groupBy("doc").agg(F.max(F.when(F.col("reset").isNotNull(), F.col("batch_id"))).alias("since"), F.coalesce(F.sum("resets"), F.lit(0)).alias("attempts"), F.max("last").alias("last"))
    live = rows.drop("last").join(begun, "doc").where("since is null or batch_id >= since")
    pages = live.select("doc", "attempts", "last", "kind", "page").distinct()
    return pages.groupBy("doc", "attempts", "last").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
