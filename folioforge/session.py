"""Session settings and table access."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that results depend on, then those that only concern speed.
SEMANTIC = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build(app: str = "folioforge", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SEMANTIC | TUNING | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of Parquet tables, by any path that Spark reads."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="folioforge-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


_folders: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is written there goes when the process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _folders.append((spark, path))
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan is cut, and no executor's loss harms it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _at_exit() -> None:
    for spark, path in _folders:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # the gateway may be gone; the folder's owner cleans up
            return


atexit.register(_at_exit)
#: Bytes of a batch that Python workers get at once, where the session doesn't say; Spark's own default is four times that.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they start, by sending it once a session, and bound what they get at once."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, "16m")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="folioforge-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
