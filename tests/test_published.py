"""Published batches: whole or not at all, once an id, over batch and stream writes."""

import os

import pytest
from pyspark.sql import functions as F

from folioforge.session import new_folder, ship
from folioforge.sources import published as P

SCHEMA = "id long, name string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def rows(spark, path):
    return sorted((r.id, r.name) for r in P.published(spark, path, SCHEMA).collect())


def numbers(spark, first, last):
    return spark.range(first, last, 1, 3).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("n"), "id")).alias("name"))


def plain(first, last):
    return [(i, f"n{i}" if i % 2 == 0 else None) for i in range(first, last)]


def test_batches_repeats_and_failures(spark):
    path = new_folder(spark, "published")
    P.publish(numbers(spark, 0, 10), path, "a")
    assert rows(spark, path) == plain(0, 10)
    P.publish(numbers(spark, 50, 60), path, "a")  # the id is taken
    P.publish(numbers(spark, 10, 12), path, "b")
    P.publish(numbers(spark, 0, 0), path, "empty")
    assert rows(spark, path) == plain(0, 12)
    bad = numbers(spark, 20, 40).withColumn("name", F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        P.publish(bad, path, "c")
    assert rows(spark, path) == plain(0, 12)
    P.publish(numbers(spark, 20, 40), path, "c")
    assert rows(spark, path) == plain(0, 12) + plain(20, 40)
    assert {(r.batch, r.rows) for r in P.manifests(spark, path).collect()} == {("a", 10), ("b", 2), ("empty", 0), ("c", 20)}
    with pytest.raises(Exception, match="append"):
        numbers(spark, 0, 1).write.format("published").mode("overwrite").option("path", path).option("batch", "d").save()


def test_a_manifest_in_the_making_is_not_read(spark):
    path = new_folder(spark, "published")
    assert rows(spark, path) == []
    P.publish(numbers(spark, 0, 4), path, "a")
    os.rename(f"{path}/manifest/a.json", f"{path}/manifest/.a-draft")
    assert rows(spark, path) == []


def test_a_stream_and_a_repeated_batch(spark):
    place = new_folder(spark, "published")
    path, checkpoint = f"{place}/out", f"{place}/checkpoint"

    def step(first, last):
        numbers(spark, first, last).write.mode("append").parquet(f"{place}/in")
        P.publish_stream(spark.readStream.schema(SCHEMA).parquet(f"{place}/in"), path, checkpoint)

    step(0, 5)
    step(5, 9)
    assert rows(spark, path) == plain(0, 9)
    last = max(n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (last, f".{last}.crc"):  # as if the process had ended before the commit was recorded
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    P.publish_stream(spark.readStream.schema(SCHEMA).parquet(f"{place}/in"), path, checkpoint)
    assert rows(spark, path) == plain(0, 9)
    step(9, 11)
    assert rows(spark, path) == plain(0, 11)
