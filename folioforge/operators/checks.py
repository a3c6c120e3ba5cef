"""Checks of uploads, settings, plans and acceptance as rows of problems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least values of the acceptance measures, and the documents that must compile: fixed values of the record format.
GATES = (("critical", 0.30), ("table", 0.95), ("checkbox", 0.98), ("speed", 0.60))
DOCUMENTS = 5


def problems(checks: Sequence[tuple[str, Column]]) -> Column:
    """The names of the checks that don't hold, in order; a check that is null doesn't hold."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in checks]))


def acceptance(rows: DataFrame) -> DataFrame:
    """Adds the gates that each row's measures miss: below the least value, above 1, or another number of documents."""
    checks = [(name, F.col(name).between(least, 1.0)) for name, least in GATES] + [("documents", F.col("documents") == DOCUMENTS)]
    return rows.withColumn("missed", problems(checks))


def uploads(rows: DataFrame, most: int) -> DataFrame:
    """Adds the problems of uploads: size, digest, and whether the content that came has both."""
    checks = [("size", F.col("size").between(1, most)), ("sha256", F.col("sha256").rlike(r"\A[0-9a-f]{64}\z")), ("length", F.col("size") == F.octet_length("content")), ("digest", F.col("sha256") == F.sha2("content", 256))]
    return rows.withColumn("problems", problems(checks))


def provider_problems(url: Column, key: Column) -> Column:
    """Problems of a provider's address, which has neither user, query nor fragment, and of its key."""
    rest = F.regexp_extract(url, r"(?i)\Ahttps?://(.*)\z", 1)
    host = F.substring_index(rest, "/", 1)
    return problems([("scheme", url.rlike(r"(?i)\Ahttps?://[^/]")), ("user", ~F.contains(host, F.lit("@"))), ("query", ~url.rlike("[?#]")), ("key", F.btrim(key) != "")])


def plan_problems(plan: DataFrame, sources: DataFrame, pinned: DataFrame) -> DataFrame:
    """What is wrong with a partition plan (``worker``, ``source``): sources missing, unknown or assigned twice, and pinned ones not with the first worker."""
    assigned = plan.groupBy("source").agg(F.count("*").alias("times"), F.max("worker").alias("worker"))
    rows = sources.select("source", F.lit(True).alias("known")).join(assigned, "source", "full").join(pinned.select("source", F.lit(True).alias("pinned")), "source", "left")
    kind = F.when(F.col("known").isNull(), "unknown").when(F.col("times").isNull(), "missing").when(F.col("times") > 1, "twice").when(F.col("pinned") & (F.col("worker") != 1), "not pinned")
    return rows.select("source", kind.alias("problem")).where("problem is not null")


def unlabelled(attributes: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Keys that have no label, with how often they occur."""
    return attributes.join(labels.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))


def key_problems(present: Column, required: Sequence[str], allowed: Sequence[str]) -> Column:
    """Keys that a mapping lacks or may not have."""
    lacking = F.transform(F.array_except(F.array(*map(F.lit, required)), present), lambda k: F.concat(F.lit("-"), k))
    return F.concat(lacking, F.transform(F.array_sort(F.array_except(present, F.array(*map(F.lit, (*required, *allowed))))), lambda k: F.concat(F.lit("+"), k)))
