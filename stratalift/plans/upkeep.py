"""Layers kept up to date by what a day brings, instead of being made anew."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalift.operators.projections import audit_columns
from stratalift.operators.upserts import CHANGE, CHANGED, EQUAL, GONE, INSERTED, upsert
from stratalift.plans.layers import FileLayer
from stratalift.plans.spec import MERGED_FROM, TableSpec
from stratalift.plans.states import keep_states, kept_group_agg
from stratalift.plans.transfers import RunOptions, audit_text
from stratalift.sinks.layers import marks


def upsert_layer(
    spark: SparkSession,
    place: FileLayer,
    snapshot: DataFrame,
    keys: Sequence[str],
    run_by: str,
    options: RunOptions,
    keep_gone: bool = True,
) -> dict[str, int]:
    """Merge a snapshot into a layer's rows (``upsert``) and publish the result.

    Returns the numbers of inserted, changed, equal and gone keys, which the tasks that write the
    rows take along. A layer without rows yet starts with the snapshot. The layer is a published
    one whatever its settings say, as the new rows are made of those they replace; a merge that fails
    leaves these.
    """
    if place.dated:
        raise ValueError("a layer of dated snapshots keeps every day as it was")
    place = replace(place, published=True)
    known = place.read(spark) if marks(spark, place.path) else None
    seen = Observation()
    counts = [F.count_if(F.col(CHANGE) == c).alias(c) for c in (INSERTED, CHANGED, EQUAL, GONE)]
    merged = upsert(known, snapshot, keys, run_by, options.run_ts).observe(seen, *counts)
    if not keep_gone:
        merged = merged.where(F.col(CHANGE) != GONE)
    place.write(merged.drop(CHANGE), options.run_date)
    return dict(seen.get)


def refresh_gold(
    spark: SparkSession, spec: TableSpec, silver: DataFrame, states: str, gold: FileLayer, options: RunOptions
) -> DataFrame:
    """The SL→GL hop of a grouped table from one day's silver rows; returns the gold table.

    The day's rows are merged with other sources as in ``transfer`` and grouped; their states are
    kept below ``states`` under the run date, and the gold rows are merged out of the states of all days. So
    a day costs its own rows and one row per group and day. A day that is run again is replaced.
    """
    if not spec.group_aggs:
        raise ValueError(f"{spec.family}/{spec.table} is not grouped")
    for step in options.merges:
        silver = step.apply(silver)
    keep_states(silver, states, options.run_date, spec.group_by, spec.group_aggs)
    groups = kept_group_agg(spark, states, spec.group_by, spec.group_aggs)
    gold.write(audit_columns(groups, audit_text(spec, MERGED_FROM, options), options.run_ts), options.run_date)
    return gold.read(spark, options.run_date)
