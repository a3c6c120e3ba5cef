"""Files as rows: which paths are safe, whose they are, and what publishing them would change.

Frames of files have a ``path`` with ``/`` between its parts, and a digest of the content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_relative(path: Column) -> Column:
    """Whether a path stays where it is put: not absolute, no ``..`` part, no backslash, colon or NUL."""
    parts = F.split(path, "/")
    odd = F.exists(F.array(*map(F.lit, ("\\", ":", "\x00"))), lambda c: F.contains(path, c))
    return F.coalesce((path != "") & ~path.startswith("/") & ~F.array_contains(parts, "..") & ~odd, F.lit(False))


def longest_prefix(files: DataFrame, prefixes: DataFrame, path: str = "path") -> DataFrame:
    """``files`` with the longest ``prefix`` that ends at a part of the path, and the other columns of its row.

    Every leading run of parts is looked up by equality, so no file meets every prefix.
    """
    rest = [c for c in prefixes.columns if c != "prefix"]
    parts = F.split(path, "/")
    lead = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    tried = files.select(path).distinct().withColumn("prefix", F.explode(lead))
    found = tried.join(prefixes, "prefix").groupBy(path).agg(F.max_by(F.struct("prefix", *rest), F.length("prefix")).alias("_found"))
    return files.join(found, path, "left").select(*files.columns, "_found.prefix", *[f"_found.{c}" for c in rest])


def rewritten(path: Column, prefix: Column, into: Column) -> Column:
    """The path with its prefix replaced; as it is without one."""
    return F.when(prefix.isNull(), path).otherwise(F.concat(into, F.substr(path, F.length(prefix) + 1)))


def publishable(path: Column, folders: Sequence[str], endings: Sequence[str]) -> Column:
    """Whether a file belongs to a publication: in no left-out folder, with no left-out ending, and not an environment file."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    left_out = F.arrays_overlap(parts, F.array(*map(F.lit, folders))) | F.exists(F.array(*map(F.lit, endings)), lambda e: name.endswith(e)) | (name == ".env") | name.startswith(".env.")
    return ~left_out


def difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """What publishing ``source`` over ``target`` does to each path: add, unchanged, conflict, or kept (only the target has it)."""
    both = source.select("path", F.col("digest").alias("new")).join(target.select("path", F.col("digest").alias("old")), "path", "full")
    change = F.when(F.col("old").isNull(), "add").when(F.col("new").isNull(), "kept").when(F.col("old") == F.col("new"), "unchanged").otherwise("conflict")
    return both.select("path", change.alias("change"))


def export_plan(files: DataFrame) -> DataFrame:
    """Moves of ``files`` to their ``target``: the first of equal ones moves, equal others are dropped, and unequal ones conflict."""
    found = files.groupBy("target").agg(F.count("*").alias("files"), F.countDistinct("digest").alias("contents"), F.min("path").alias("first"))
    rows = files.join(found, "target")
    return rows.withColumn("action", F.when(F.col("contents") > 1, "conflict").when(F.col("path") == F.col("first"), "move").otherwise("drop")).select("path", "target", "action")


def digests(files: DataFrame, by: str) -> DataFrame:
    """One digest a group of files: over the length and text of each path and its digest, in the order of paths.

    Contents are digested file by file, so a group's row holds its list of files, not their bytes.
    """
    line = F.concat(F.length("path").cast("string"), F.lit(":"), F.col("path"), F.col("digest"))
    listed = F.array_sort(F.collect_list(F.struct("path", line.alias("line"))))
    return files.groupBy(by).agg(F.count("*").alias("files"), F.sha2(F.array_join(F.transform(listed, lambda x: x["line"]), "\n"), 256).alias("digest"))


def catalog_id(unit: Column, path: Column, modified: Column, size: Column) -> Column:
    """The first 32 digits of a SHA-256 that names a version of a file."""
    return F.left(F.sha2(F.concat_ws(":", unit, path, modified.cast("string"), size.cast("string")), 256), F.lit(32))


def natural_key(name: Column, digits: int = 12) -> Column:
    """A key by which numbers in names sort as numbers."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(name), F.lit("[0-9]+|[^0-9]+"), F.lit(0)), lambda x: F.when(x.rlike("^[0-9]"), F.lpad(F.ltrim(x, F.lit("0")), digits, "0")).otherwise(x)), "")
