"""Landing what has arrived since the last run, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def land_arrivals(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
) -> int:
    """Land the rows of all files of ``source`` that no earlier run has landed; returns their number.

    The checkpoint, in a store that all share, knows the files, so neither the source nor the
    landed table is searched for a newest date, and rows that come late are landed like any others. A run
    that was ended half-way goes on where it stopped, and every row is landed once: the
    target's own log names the files of whole batches, and only those are read back.
    ``shape`` may project, filter and cast the rows. ``files_per_batch`` bounds a batch of a
    source with very many new files. Without ``schema`` that of the files there are counts; an empty
    source then has nothing to land.
    """
    if schema is None:
        # file streams take no schema from the data by themselves
        schema = spark.read.format(fmt).load(source).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    if shape is not None:
        rows = shape(rows)
    writer = rows.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(progress.numInputRows for progress in query.recentProgress)


def read_arrivals(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """What has been landed: the files of whole batches, by the target's log."""
    return spark.read.format(fmt).load(target)
