"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# The folder of the innermost ``scratch`` block.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def staging_path(spark: SparkSession, name: str = "rows") -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of the machine.
    """
    if scratch_folder := _SCRATCH.get():
        return f"{scratch_folder}/{name}-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="stratalift-")
    return f"{root.rstrip('/')}/stratalift/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged in the block goes below one folder, which is deleted at its end.

    Tables that are to outlive the block are staged at a ``staging_path`` taken before it.
    """
    folder = staging_path(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        delete_folder(spark, folder)


def stage_rows(df: DataFrame, name: str = "rows", path: str | None = None) -> DataFrame:
    """Write the rows as a table and read it back: cuts the lineage, survives lost executors."""
    return _stage(df, path or staging_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str = "rows") -> Iterator[DataFrame]:
    """The rows as such a table, which is deleted at the end of the block."""
    path = staging_path(df.sparkSession, name)
    try:
        yield _stage(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of any store that Spark reaches."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, whole as soon as it is there."""
    system, file = _folder(spark, path)
    system.create(file, False).close()


def _folder(spark: SparkSession, path: str):
    # the only place that goes through the driver's JVM, which Spark Connect does not offer
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
