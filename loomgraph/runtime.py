"""Scratch tables in the folder that all machines share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of Parquet up to which `bounded` has a table broadcast.
BROADCAST_BYTES = 4 << 20


#: What `made` watches: each list gets the paths of scratch tables as these are made.
_WATCHED: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, one is set if all runs on this machine, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: a folder that the driver and all executors share is needed")
        at = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/loom-{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    for paths in _WATCHED:
        paths.append(path)
    return path


@contextmanager
def made() -> Iterator[list[str]]:
    """The paths of the scratch tables that are made in the block."""
    paths: list[str] = []
    _WATCHED.append(paths)
    try:
        yield paths
    finally:
        _WATCHED.pop()


def only(make: Callable[[], DataFrame]) -> DataFrame:
    """The staged table that make returns. Other scratch tables that it made on the way are removed, as a driver that lives
    long would gather them; so what make returns is all that may be used of it."""
    with made() as paths:
        out = make()
    for path in paths:
        if path != out.scratch_path:
            remove(out.sparkSession, path)
    return out


def remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone; the folder is scratch space
        pass


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, name: str = "table") -> DataFrame:
    """df written once as Parquet and read again: cuts lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = scratch(spark, name)
    # What a finished write has shuffled may go at once.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def bucketed(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """df written once, dealt and sorted by key, into as many buckets as there are shuffle partitions: joins on key read
    it without a shuffle. The table is dropped when the driver ends; its files are in the shared folder."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, called = scratch(spark, name), f"loom_{name}_{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(called)
    atexit.register(_drop, spark, called)
    return spark.table(called)


def _drop(spark: SparkSession, called: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {called}")
    except Exception:  # the session may be gone
        pass


def replace(old: DataFrame | None, new: DataFrame, name: str = "table") -> DataFrame:
    """new staged; the scratch table of old, if it has one, is removed."""
    out = staged(new, name)
    if old is not None and hasattr(old, "scratch_path"):
        remove(out.sparkSession, old.scratch_path)
    return out


class Parts:
    """A table that grows by parts, each of which is written once."""

    def __init__(self, name: str = "parts"):
        self.name, self.tables = name, []

    def add(self, df: DataFrame) -> DataFrame:
        """df as it was written; an empty part is not kept."""
        part = staged(df, self.name)
        if not self.tables or not part.isEmpty():
            self.tables.append(part)
        return part

    def all(self) -> DataFrame:
        first = self.tables[0]
        return first.sparkSession.read.schema(first.schema).parquet(*(t.scratch_path for t in self.tables))


def bounded(table: DataFrame, *columns, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A staged table, or these columns of it, marked for broadcast if its files have at most limit bytes, else for a
    merge join."""
    spark = table.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    out = table.select(*columns) if columns else table
    return F.broadcast(out) if size <= limit else out.hint("merge")
