"""Where a layer's table lives."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from stratalift.sinks.layers import (
    MAX_RECORDS_PER_FILE,
    dated_path,
    dated_snapshot,
    publish_layer,
    write_layer,
)
from stratalift.sources.layers import read_dated, read_layer


@dataclass(frozen=True)
class FileLayer:
    """A table of files; ``dated`` keeps one snapshot per run date, ``published`` writes beside
    the rows there are and puts the new ones in their place when they are whole."""

    path: str
    fmt: str = "parquet"
    max_records: int = MAX_RECORDS_PER_FILE
    dated: bool = False
    published: bool = False

    def read(self, spark: SparkSession, run_date: date | str | None = None) -> DataFrame:
        if self.dated:
            return read_dated(spark, self.path, run_date, self.fmt)
        return read_layer(spark, self.path, self.fmt)

    def place(self, run_date: date | str) -> str:
        """The folder that a run of that day writes."""
        return dated_path(self.path, run_date) if self.dated else self.path

    def write(self, df: DataFrame, run_date: date | str) -> None:
        if self.dated:
            dated_snapshot(df, self.path, run_date, self.fmt, self.max_records, self.published)
        elif self.published:
            publish_layer(df, self.path, self.fmt, self.max_records)
        else:
            write_layer(df, self.path, self.fmt, self.max_records)


@dataclass(frozen=True)
class CustomLayer:
    """A source or destination given by functions, such as an API or a database."""

    reader: Callable[[SparkSession], DataFrame] | None = None
    writer: Callable[[DataFrame], None] | None = None

    def read(self, spark: SparkSession, run_date: date | str | None = None) -> DataFrame:
        if self.reader is None:
            raise ValueError("layer cannot be read")
        return self.reader(spark)

    def write(self, df: DataFrame, run_date: date | str) -> None:
        if self.writer is None:
            raise ValueError("layer cannot be written")
        self.writer(df)


Layer = FileLayer | CustomLayer


def layers_from_config(stages: Mapping[str, Mapping[str, Any]], root: str) -> dict[str, FileLayer]:
    """File layers below ``root`` from the stages of a nested configuration.

    A stage's ``Provider`` has ``Format``, ``Write.MaxRecordsPerFile`` and
    ``SubDir.Path``, which is set where the layer keeps a snapshot per day. Stages without
    a file format (an API, a database) need functions and are left out.
    """
    layers = {}
    for name, stage in stages.items():
        provider = stage.get("Provider") or {}
        fmt = provider.get("Format")
        if fmt and fmt != "jdbc":
            most = (provider.get("Write") or {}).get("MaxRecordsPerFile", MAX_RECORDS_PER_FILE)
            dated = bool((provider.get("SubDir") or {}).get("Path"))
            layers[name] = FileLayer(f"{root.rstrip('/')}/{name}", fmt, most, dated)
    return layers
