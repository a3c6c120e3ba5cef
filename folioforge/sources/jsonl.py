"""Ledgers as lines of JSON, written by Spark's commit protocol and read strictly or leniently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write(rows: DataFrame, path: str, append: bool = True) -> None:
    """One object a line; null fields are kept. A lost executor leaves no partial file, and readers see all of a write or nothing."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every line that isn't blank: ``file``, ``raw``, and ``value``, null if it isn't an object of ``schema``."""
    raw = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw")).where(F.btrim("raw") != "")
    whole = F.try_parse_json("raw").isNotNull() & F.btrim("raw").startswith("{")
    return raw.withColumn("value", F.when(whole, F.from_json("raw", schema)))


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a ledger; the first line that can't be read stops the query with its text."""
    rows = lines(spark, path, schema)
    checked = F.when(F.col("value").isNotNull(), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a ledger line: "), F.left("raw", F.lit(200)))))
    return rows.select(checked.alias("value")).select("value.*")


def read_counted(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows that can be read, and the number of others by file."""
    rows = lines(spark, path, schema)
    return rows.where("value is not null").select("value.*"), rows.where("value is null").groupBy("file").agg(F.count("*").alias("malformed"))
