"""Comparing the layers of tables.

A layer is given as its rows or as a function that reads them. Each is looked at on its
own: one that cannot be read is a row with its failure, the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.operators.integrity import dataset_checksum
from stratalift.operators.metrics import row_count
from stratalift.operators.rows import preview

# table name -> layer name, in lineage order -> the layer's rows, or what reads them
Tables = Mapping[str, Mapping[str, DataFrame | Callable[[], DataFrame]]]


def layer_row_counts(spark: SparkSession, tables: Tables) -> DataFrame:
    """``table_name, layer, rows, failure``, one row per layer."""
    found = _each(tables, row_count)
    return spark.createDataFrame(found, "table_name string, layer string, rows long, failure string")


def layer_checksum_diff(
    spark: SparkSession, tables: Tables, mode: str = "additive", strict: bool = False
) -> DataFrame:
    """``table_name, layer, checksum, verdict, failure``, each layer against the one before it.

    The verdict is ``Baseline`` for a table's first layer, then ``same`` or
    ``not equal``. A layer that cannot be read has none, and the next one is compared
    with the last that could. ``strict`` tells a NULL from its neighbours' place.
    """
    found = []
    before: dict[str, str | None] = {}
    digests = _each(tables, lambda df: dataset_checksum(df, mode, strict).select("checksum"))
    for name, layer, checksum, failure in digests:
        verdict = None
        if failure is None:
            verdict = "Baseline"
            if name in before:
                verdict = "same" if checksum == before[name] else "not equal"
            before[name] = checksum
        found.append((name, layer, checksum, verdict, failure))
    return spark.createDataFrame(
        found, "table_name string, layer string, checksum string, verdict string, failure string"
    )


def _each(tables: Tables, measure: Callable[[DataFrame], DataFrame]) -> list[tuple]:
    """Table, layer, what was measured (a frame of one value) and the failure, for every layer.

    All layers are measured in one job, whose stages run side by side. Only where that fails,
    which no analysis has foretold, each is measured on its own.
    """
    frames: dict[tuple[str, str], DataFrame] = {}
    failures: dict[tuple[str, str], str] = {}
    for name, by_layer in tables.items():
        for layer, given in by_layer.items():
            try:
                frames[name, layer] = measure(given() if callable(given) else given).toDF("value")
            except Exception as error:  # the other layers are measured all the same
                failures[name, layer] = f"{type(error).__name__}: {error}"
    values: dict[tuple[str, str], object] = {}
    try:
        labelled = [df.select(F.lit(at).alias("at"), "value") for at, df in enumerate(frames.values())]
        rows = reduce(DataFrame.unionByName, labelled).collect() if labelled else []
        values = {list(frames)[r["at"]]: r["value"] for r in rows}
    except Exception:
        for key, frame in frames.items():
            try:
                values[key] = frame.first()["value"]
            except Exception as error:
                failures[key] = f"{type(error).__name__}: {error}"
    every = [(name, layer) for name, by_layer in tables.items() for layer in by_layer]
    return [(*key, values.get(key), failures.get(key)) for key in every]


def display_layers(tables: Tables, rows: int = 20) -> dict[tuple[str, str], DataFrame]:
    """A preview of every layer of every table."""
    return {
        (name, layer): preview(given() if callable(given) else given, rows)
        for name, by_layer in tables.items()
        for layer, given in by_layer.items()
    }
