"""Log files that grow, as a stream of their complete lines.

``LogSource`` is a streaming source of Spark. Its offset holds, for each file, the
byte after its last line end, and a digest of the bytes at its beginning and before
that place. An offset depends on the files alone, so a restart needs nothing but the
checkpoint. Between two offsets a file is read from where it was, if the bytes before
that place are still the same; else it was truncated, replaced or written anew, and
is read from its beginning. What stands after the last line end waits for its rest.

The driver lists the files and reads, of those whose size or time has changed, the
anchors and the tail back to the last line end; tasks read the new bytes, long ranges
by ``chunk`` bytes. An offset has one small entry a file, so a folder should hold
thousands of files rather than millions.

``lines_of`` makes a stream of rows ``file``, ``at`` (the line's first byte), ``line``
and ``restarted``: one row with that flag, and without a line, comes for a file that
begins anew or is gone, and what it gave before is void. ``append_lines`` keeps the
rows and ``current_lines`` those that count. Bytes that aren't UTF-8 become U+FFFD; a
file that is replaced while a batch is being repeated gives the batch nothing, and its
new content to the next one.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

ANCHOR = 64
TAIL = 256
SCHEMA = "file string, at long, line string, restarted boolean"
_ARROW = pa.schema([("file", pa.string()), ("at", pa.int64()), ("line", pa.string()), ("restarted", pa.bool_())])
# Spark runs some of this in processes beside the driver that get none of the files sent to executors: it goes there by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of lines in a batch of rows.
ROWS_BYTES = 1 << 20


def _read(files: fs.FileSystem, path: str, at: int, n: int) -> bytes:
    with files.open_input_file(path) as stream:
        stream.seek(at)
        return stream.read(max(0, n))


def anchor(files: fs.FileSystem, path: str, end: int) -> str:
    """A digest of the first bytes and those before ``end``, by which a file is known again."""
    head = _read(files, path, 0, min(ANCHOR, end))
    return hashlib.sha256(head + b"\n" + _read(files, path, max(0, end - ANCHOR), min(ANCHOR, end))).hexdigest()[:32]


def last_line_end(files: fs.FileSystem, path: str, size: int) -> int:
    """The byte after the last line end, 0 if there is none; reads back from the end."""
    at = size
    while at > 0:
        begin = max(0, at - TAIL)
        found = _read(files, path, begin, at - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    return 0


class Range(InputPartition):
    def __init__(self, name: str, path: str, begin: int, at: int, end: int, last: int, known: str | None) -> None:
        self.name, self.path, self.begin, self.at, self.end, self.last, self.known = name, path, begin, at, end, last, known


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.chunk = int(options.get("chunk", 32 << 20))
        self._seen: dict[str, tuple] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder if "://" in self.folder or not self.folder.startswith("file:") else "file://" + self.folder[5:])

    def latestOffset(self) -> dict:
        files, root = self._files()
        found = {}
        for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.path[len(root) :].lstrip("/")
            if info.type != fs.FileType.File or not fnmatch(info.base_name, self.pattern):
                continue
            state = (info.size, info.mtime_ns)
            try:
                if name not in self._seen or self._seen[name][0] != state:
                    end = last_line_end(files, info.path, info.size)
                    self._seen[name] = (state, {"at": end, "anchor": anchor(files, info.path, end)})
            except FileNotFoundError:  # it went after it was listed
                continue
            found[name] = self._seen[name][1]
        self._seen = {n: s for n, s in self._seen.items() if n in found}
        return {"files": found}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files, root = self._files()
        before, now = start["files"], end["files"]
        out = [Range(name, "", 0, 0, 0, 0, None) for name in before if name not in now]
        for name, to in now.items():
            was = before.get(name)
            if was == to:
                continue
            path, at = f"{root}/{name}", was["at"] if was else 0
            if was:
                try:
                    same = at <= to["at"] and anchor(files, path, at) == was["anchor"]
                except (FileNotFoundError, OSError):
                    same = False
                if not same:
                    out.append(Range(name, "", 0, 0, 0, 0, None))
                    at = 0
            out += [Range(name, path, at, k, min(k + self.chunk, to["at"]), to["at"], to["anchor"]) for k in range(at, to["at"], self.chunk)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            yield pa.RecordBatch.from_arrays([pa.array([part.name]), pa.array([None], pa.int64()), pa.array([None], pa.string()), pa.array([True])], schema=_ARROW)
            return
        files, _ = self._files()
        try:
            if anchor(files, part.path, part.last) != part.known:
                return
            yield from self._lines(files, part)
        except FileNotFoundError:
            return

    def _lines(self, files: fs.FileSystem, part: Range) -> Iterator[pa.RecordBatch]:
        """The lines whose first byte is in the part's range."""
        with files.open_input_file(part.path) as stream:
            at = part.at
            if at > part.begin:  # the line that reaches into the range belongs to the one before
                stream.seek(at - 1)
                while at < part.end:
                    block = stream.read(min(ROWS_BYTES, part.last - at + 1))
                    found = block.find(b"\n")
                    if found >= 0:
                        at += found
                        break
                    at += len(block)
            rest = b""
            stream.seek(at)
            while at < part.end or rest:
                want = min(ROWS_BYTES, part.last - at - len(rest))
                block = rest + stream.read(want) if want > 0 else rest
                cut = block.rfind(b"\n") + 1
                if not cut:
                    if want <= 0:
                        return
                    rest = block
                    continue
                lines, starts, place = [], [], at
                for line in block[:cut].splitlines(keepends=True) if b"\r" not in block else [x + b"\n" for x in block[: cut - 1].split(b"\n")]:
                    if place >= part.end:
                        break
                    starts.append(place)
                    lines.append(line[:-1].decode(errors="replace"))
                    place += len(line)
                if lines:
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays([pa.array([part.name] * n), pa.array(starts, pa.int64()), pa.array(lines, pa.string()), pa.array([False] * n)], schema=_ARROW)
                at, rest = at + cut, block[cut:]
                if at >= part.end:
                    return


class LogSource(DataSource):
    """``spark.readStream.format("growing_logs")`` with options ``path``, ``pattern`` (of file names) and ``chunk``."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(dict(self.options))


def lines_of(spark: SparkSession, folder: str, pattern: str = "*", chunk: int = 32 << 20) -> DataFrame:
    spark.dataSource.register(LogSource)
    return spark.readStream.format("growing_logs").option("path", folder).option("pattern", pattern).option("chunk", chunk).load()


def append_lines(lines: DataFrame, path: str) -> None:
    """Adds what is new now to the table at ``path``; a batch that runs twice writes the same folder."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/lines/batch={batch_id:08d}")

    lines.writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(append).trigger(availableNow=True).start().awaitTermination()


def current_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``at`` and ``line`` of the lines that the files hold: those since each last began anew."""
    rows = spark.read.schema(SCHEMA + ", batch_id int, batch string").parquet(f"{path}/lines").drop("batch")
    begun = rows.where("restarted").groupBy("file").agg(F.max("batch_id").alias("begun"))
    rows = rows.where("not restarted").join(begun, "file", "left")
    return rows.where(F.col("begun").isNull() | (F.col("batch_id") >= F.col("begun"))).select("file", "at", "line")
