"""Intermediate tables that outlive the executors that computed them."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_run = f"starloom-{uuid.uuid4().hex}"
_local: dict[str, str] = {}
_cleaned: set[tuple[str, str]] = set()


def scratch_root(spark: SparkSession) -> str:
    """The run's own folder below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local temporary folder serves a local master; any other
    master raises, as executors would each write to a disk of their own.  The folder
    is removed when the driver's Python ends, also after an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or (
            spark.sparkContext.master.startswith("local-cluster")
        ):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "folder" not in _local:
            _local["folder"] = tempfile.mkdtemp(prefix="starloom-")
        shared = f"file://{_local['folder']}"
    root = f"{shared.rstrip('/')}/{_run}"
    key = (spark.sparkContext.applicationId, root)
    if key not in _cleaned:
        _cleaned.add(key)
        atexit.register(_remove_at_exit, spark, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the run's folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files at their end.

    Otherwise those stay until the driver collects its garbage.  A staged table takes the
    place of the shuffles that made it; nothing reads them again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, for plans that use it repeatedly."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_end_with_query(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing happens if it is gone."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _remove_at_exit(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:
        remove(spark, root)


class Workspace:
    """Staged tables of one operator, removable one by one once they are used up."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_end_with_query(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.path(name))
