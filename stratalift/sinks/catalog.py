"""Catalog tables and the audit trail kept in one."""

from __future__ import annotations

import re
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratalift.functions.columns import col

_APPENDS = threading.Lock()


def catalog_name(parent: str, family: str, table: str, layer: str) -> str:
    """``parent.family_table_layer``; characters a catalog rejects become ``_``."""
    parts = [re.sub(r"\W", "_", part) for part in (family, table, layer)]
    return f"{parent}.{'_'.join(parts)}"


def write_catalog(
    df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None
) -> None:
    """Overwrite a catalog table, schema included."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, fmt: str = "parquet", path: str | None = None
) -> None:
    """Overwrite a catalog table whose rows are kept by the hash of their keys, sorted within.

    Joins, groupings and keyed duplicate removal by these keys then need no shuffle, between
    tables of as many buckets. A bucket is one file; a key that holds many rows makes a long one.
    """
    dealt = df.repartition(buckets, *[col(k) for k in keys])
    writer = dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def register_catalog(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """Point a catalog table at files already written, so they are not written twice.

    A table of that name is replaced only if it points at files too: dropping
    one that the catalog manages would delete its rows, so that raises.
    """
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} holds rows of its own and is not replaced")
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)


def append_audit(report: DataFrame, table: str, path: str | None = None) -> None:
    """Append run reports to the audit table; ``path`` places a new one.

    One append at a time: file tables lose rows to jobs that commit beside each other.
    """
    writer = report.write.mode("append")
    if path is not None:
        writer = writer.option("path", path)
    with _APPENDS:
        writer.saveAsTable(table)
