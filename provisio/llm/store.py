"""Tables and files of intermediate results in the folder that all executors share."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from provisio.session import new_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BUCKET_BYTES = 6 << 20  # of packed records that one bucket holds on average


def store(df: DataFrame, name: str, codec: str = "snappy", rows: int | None = None) -> DataFrame:
    """Write a result as Parquet and read it again: lineage ends here, and its shuffle files go."""
    return df.sparkSession.read.parquet(write(df, name, codec, rows))


def write(df: DataFrame, name: str, codec: str = "snappy", rows: int | None = None) -> str:
    """``rows``: at most so many rows in an Arrow batch, for rows that hold long values."""
    path = new_path(df.sparkSession, name)
    with settings(df.sparkSession, {CLEANUP: "true"} | ({BATCH: str(rows)} if rows else {})):
        df.write.parquet(path, compression=codec)
    return path


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs inside; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def tidy(run: Callable) -> Callable:
    """A ``mapInArrow`` function that leaves no free memory behind: workers live on, and those of later stages add up."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the table does not have, whatever the case of its own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for Python tasks: any URI that Arrow knows, or a plain path."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def buckets_for(spark: SparkSession, n_bytes: float, least: int = 1) -> int:
    """Number of buckets that grows with the data, and is at least the shuffle partitions."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / BUCKET_BYTES))
