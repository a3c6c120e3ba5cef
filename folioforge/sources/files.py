"""Files that Spark lists and reads as bytes."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte order marks and the encodings tried without one, in order: fixed values of the text format.
MARKS = ((codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
LADDER = ("utf-8", "gb18030", "big5")
DECODED = "text string, encoding string, had_bom boolean, error string"


def inventory(spark: SparkSession, root: str, ending: str) -> DataFrame:
    """Files under ``root`` with an ending in any case: ``path`` below the root, ``length`` and ``modified``. Hidden files and folders are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[!.]*").load(root)
    path = F.regexp_replace(F.col("path"), "^.*?" + _quoted(root.split("://")[-1].strip("/")) + "/", "")
    rows = files.select(path.alias("path"), "length", F.col("modificationTime").alias("modified"))
    return rows.where(F.lower("path").endswith(ending.lower()) & ~F.exists(F.split("path", "/"), lambda part: part.startswith(".")))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def decode(data: bytes | None) -> tuple[str | None, str | None, bool, str | None]:
    """Text, encoding, whether a mark named it, and why it can't be read."""
    if data is None:
        return None, None, False, "missing"
    mark, names = next(((m, (name,)) for m, name in MARKS if data.startswith(m)), (b"", LADDER))
    for name in names:
        try:
            text = data[len(mark) :].decode(name)
        except UnicodeDecodeError:
            continue
        return (None, name, bool(mark), "NUL character") if "\0" in text else (text, name, bool(mark), None)
    return None, None, bool(mark), "unknown encoding"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.bool_(), pa.string())
    for batch in batches:
        found = list(zip(*map(decode, batch.column(1).to_pylist()), strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found, kinds)], names=["key", "text", "encoding", "had_bom", "error"])


def decoded(files: DataFrame, key: str, content: Column) -> DataFrame:
    """``key`` with the text of its bytes: a byte order mark decides, else the first encoding that reads all of it."""
    kind = files.schema[key].dataType.simpleString()
    return files.select(F.col(key).alias("key"), content.alias("content")).mapInArrow(_decode, f"key {kind}, {DECODED}").withColumnRenamed("key", key)
