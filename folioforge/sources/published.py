"""Publishing rows so that readers see a batch whole or not at all.

Tasks write Parquet files under names of their own; the driver then writes one manifest
for the batch, which lists its files and rows, to a temporary name and moves it into
place. Readers take only files that a manifest lists, so nothing of a failed or unfinished
write is ever seen, and the manifest is the mark that a batch is done. A batch id that has
its manifest already is not published again: what was written anew is deleted. Streams
use their batch ids. One process publishes to a folder at a time, as streams do.

Columns keep their types; an empty batch has a manifest without files.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from folioforge.session import exists


# Spark runs some of this in processes beside the driver that get none of the files sent to executors: it goes there by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class _Files:
    """Writes the files of a batch, and publishes or deletes them."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write_rows(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, root = place(self.path)
        name, rows, writer, stream = f"{uuid.uuid4().hex}.parquet", 0, None, None
        files.create_dir(f"{root}/data", recursive=True)
        for batch in batches:
            if writer is None:
                stream = files.open_output_stream(f"{root}/data/{name}")
                writer = pq.ParquetWriter(stream, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        stream.close()
        return Written(name, rows)

    def publish(self, messages: list[Written | None], batch: str) -> None:
        files, root = place(self.path)
        done = f"{root}/manifest/{batch}.json"
        if files.get_file_info(done).type != fs.FileType.NotFound:
            self.delete(messages)
            return
        listed = [m for m in messages if m is not None and m.file]
        files.create_dir(f"{root}/manifest", recursive=True)
        draft = f"{root}/manifest/.{batch}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as stream:
            stream.write(json.dumps({"batch": batch, "rows": sum(m.rows for m in listed), "files": sorted(m.file for m in listed)}).encode())
        files.move(draft, done)

    def delete(self, messages: list[Written | None]) -> None:
        files, root = place(self.path)
        for m in messages:
            if m is not None and m.file:
                files.delete_file(f"{root}/data/{m.file}")


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str) -> None:
        self.files, self.batch = _Files(path), batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write_rows(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.files.publish(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.files.delete(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self.files = _Files(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write_rows(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.files.publish(messages, f"{batchId:012d}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.files.delete(messages)


class PublishedSink(DataSource):
    """``df.write.format("published")`` and ``writeStream``, with options ``path`` and, for batches, ``batch``: the batch's id."""

    @classmethod
    def name(cls) -> str:
        return "published"

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("batches are added, never overwritten: use mode append")
        return BatchWriter(self.options["path"], self.options["batch"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"])


def publish(rows: DataFrame, path: str, batch: str) -> None:
    """Add ``rows`` as one batch, or nothing if ``batch`` is published already."""
    rows.sparkSession.dataSource.register(PublishedSink)
    rows.write.format("published").mode("append").option("path", path).option("batch", batch).save()


def publish_stream(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Add what a stream has now, a batch at a time."""
    rows.sparkSession.dataSource.register(PublishedSink)
    rows.writeStream.format("published").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """``batch``, ``rows`` and ``files`` of what is published; none if nothing was."""
    schema = "batch string, rows long, files array<string>"
    if not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(f"{path}/manifest")


def published(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of all published batches."""
    names = [f for r in manifests(spark, path).select("files").toLocalIterator() for f in r.files]
    reader = spark.read.schema(schema)
    return reader.parquet(*[f"{path}/data/{n}" for n in names]) if names else spark.createDataFrame([], schema)
