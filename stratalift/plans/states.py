"""Group aggregates kept up to date: states per run date that are merged, not grouped anew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col
from stratalift.operators.metrics import AGGREGATES
from stratalift.sinks.layers import current_path, dated_path, dated_snapshot
from stratalift.sources.layers import run_dates

# What each aggregate is made of, and how these merge.
PARTS = {"SUM": ("sum",), "AVG": ("sum", "count"), "MIN": ("min",), "MAX": ("max",), "COUNT": ("count",)}
TAKE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def partial_states(df: DataFrame, by: Sequence[str], aggs: Mapping[str, str]) -> DataFrame:
    """Per group the sums, counts, minima and maxima that ``aggs`` (as for ``group_agg``) needs."""
    states = [TAKE[part](col(field)).alias(f"{field}|{part}") for field, part in _needed(aggs)]
    return df.groupBy(*[col(c) for c in by]).agg(*states)


def merge_states(states: DataFrame, by: Sequence[str], aggs: Mapping[str, str]) -> DataFrame:
    """What ``group_agg`` gives over all rows that went into the states.

    Averages come from sums and counts, so days of different size weigh as they should.
    """
    merged = states.groupBy(*[col(c) for c in by]).agg(
        *[
            # a sum of sums has the type of the sum
            MERGE[part](col(f"{field}|{part}")).cast(states.schema[f"{field}|{part}"].dataType).alias(f"{field}|{part}")
            for field, part in _needed(aggs)
        ]
    )
    outputs = []
    for target, word in aggs.items():
        field, _, alias = target.partition(":")
        outputs.append(_final(merged, field, word.upper()).alias(alias or field))
    return merged.select(*[col(c) for c in by], *outputs)


def keep_states(
    df: DataFrame, path: str, run_date: date | str, by: Sequence[str], aggs: Mapping[str, str]
) -> None:
    """Keep the states of one day's rows. A day that is kept again replaces what was kept of it."""
    dated_snapshot(partial_states(df, by, aggs), path, run_date)


def kept_group_agg(
    spark: SparkSession, path: str, by: Sequence[str], aggs: Mapping[str, str]
) -> DataFrame:
    """The aggregate over all kept days, from their states alone."""
    days = [current_path(spark, dated_path(path, day)) for day in run_dates(spark, path)]
    if not days:
        raise ValueError(f"no states are kept in {path}")
    states = spark.read.parquet(*days)
    return merge_states(states, by, aggs)


def _needed(aggs: Mapping[str, str]) -> list[tuple[str, str]]:
    found: dict[tuple[str, str], None] = {}
    for target, word in aggs.items():
        if word.upper() not in PARTS:
            raise ValueError(f"unknown aggregate {word!r}, expected one of {', '.join(AGGREGATES)}")
        found |= dict.fromkeys((target.partition(":")[0], part) for part in PARTS[word.upper()])
    return list(found)


def _final(merged: DataFrame, field: str, word: str) -> Column:
    if word != "AVG":
        return col(f"{field}|{PARTS[word][0]}")
    total, n = col(f"{field}|sum"), col(f"{field}|count")
    kind = merged.schema[f"{field}|sum"].dataType
    if isinstance(kind, T.DecimalType):
        # the type of an average, by that of the sum
        scale = min(38, kind.scale + 4)
        return F.try_divide(total, n).cast(T.DecimalType(min(38, max(kind.precision - 6, scale)), scale))
    return F.try_divide(total.cast("double"), n)
