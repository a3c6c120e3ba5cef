"""Tables written in the folder that the driver and all executors share.

Long plans are cut by writing a Parquet table there and reading it back: such a
table survives the loss of any executor, unlike cached or locally kept blocks.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioforge.session import delete, shared_dir

_LIVE: list[tuple[SparkSession, str]] = []


#: Rows of two or three integers that may be broadcast: about 6 MB.
LIGHT_ROWS = 200_000
#: Rows of a few numbers in a file.
FILE_ROWS = 50_000


def light(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few; the result is the same either way."""
    return F.broadcast(df) if rows <= LIGHT_ROWS else df


class Scratch:
    """The tables of one operator call, in a folder of their own.

    They stay until ``drop``, ``release`` or the end of the process, because the
    operator's lazy result may still read them.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        _LIVE.append((spark, self.root))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, table: str, most: int | None = None) -> DataFrame:
        """Write ``df`` and return a frame that reads it back.

        ``most`` rows of a few numbers, if known, make as few files as they need.
        """
        path = self.path(table)
        if most is not None:
            df = df.coalesce(1 + most // FILE_ROWS)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def counted(self, df: DataFrame, table: str, most: int | None = None) -> tuple[DataFrame, int]:
        """Like ``keep``, with the number of rows, which the same job counts."""
        seen = Observation()
        out = self.keep(df.observe(seen, F.count(F.lit(1)).alias("n")), table, most)
        return out, seen.get["n"]

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in frames:
            if path := self._paths.pop(id(df), None):
                delete(self.spark, path)


@contextmanager
def recorded() -> Iterator[list[tuple[SparkSession, str]]]:
    """The folders that operator calls inside the block make, for ``release``."""
    made: list[tuple[SparkSession, str]] = []
    before = len(_LIVE)
    yield made
    made.extend(_LIVE[before:])


def release(made: list[tuple[SparkSession, str]]) -> None:
    """Delete folders whose operators' results are written or not wanted any more."""
    while made:
        spark, root = made.pop()
        delete(spark, root)
        _LIVE.remove((spark, root))


def _at_exit() -> None:
    for spark, root in _LIVE:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, root)
        except Exception:  # the gateway may be gone; the folder's owner cleans up
            return


atexit.register(_at_exit)
