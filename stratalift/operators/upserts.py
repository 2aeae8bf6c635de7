"""A snapshot merged into the rows that are known, by key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.functions.columns import col, regular_columns
from stratalift.operators.integrity import row_digest
from stratalift.operators.projections import STAMPS, audit_columns, exclude_row_columns
from stratalift.operators.rows import dedupe

CHANGE = "Row_Change"
INSERTED, CHANGED, EQUAL, GONE = "inserted", "changed", "equal", "gone"


def upsert(
    known: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    run_by: str,
    run_ts: datetime | str | None = None,
    keep_gone: bool = True,
) -> DataFrame:
    """The rows of both, with audit columns and ``Row_Change``.

    A key that is new is ``inserted`` and stamped. One whose row digest differs is ``changed``:
    it takes the snapshot's values, keeps who inserted it and when, and gets a new
    ``Row_Updated-On`` and ``-By``. One that is ``equal`` keeps all stamps. A known key
    that the snapshot lacks is ``gone``; its row stays as it is unless ``keep_gone`` is false,
    which drops it. A NULL is a key like others. Of several rows of a key in the snapshot the
    first in the order of all columns counts. Columns that only the known rows have keep
    their values and take no part in the comparison; new ones are NULL in rows that are gone.
    """
    fresh = dedupe(exclude_row_columns(snapshot), keys)
    stamped = audit_columns(fresh, run_by, run_ts)
    if known is None:
        return stamped.withColumn(CHANGE, F.lit(INSERTED))
    names = fresh.columns
    lacking = [c for c in names if c not in known.columns]
    aligned = known.withColumns({c: F.lit(None).cast(fresh.schema[c].dataType) for c in lacking})
    old = aligned.select(
        F.struct(*[col(c) for c in aligned.columns]).alias("__old"),
        row_digest(aligned.select(*map(col, names)), strict=True).alias("__old_digest"),
    )
    new = stamped.select(
        F.struct(*[col(c) for c in stamped.columns]).alias("__new"),
        row_digest(fresh, strict=True).alias("__new_digest"),
    )
    same = reduce(Column.__and__, [F.col("__old")[k].eqNullSafe(F.col("__new")[k]) for k in keys])
    met = old.join(new, same, "full_outer")
    change = (
        F.when(F.col("__old").isNull(), INSERTED)
        .when(F.col("__new").isNull(), GONE)
        .when(F.col("__old_digest") == F.col("__new_digest"), EQUAL)
        .otherwise(CHANGED)
    )
    met = met.withColumn(CHANGE, change)
    if not keep_gone:
        met = met.where(F.col(CHANGE) != GONE)
    renewed = F.col(CHANGE).isin(INSERTED, CHANGED)

    def value(name: str) -> Column:
        before = F.col("__old")[name] if name in aligned.columns else F.lit(None)
        if name not in stamped.columns:
            return before
        now = F.col("__new")[name]
        if name in STAMPS[:2]:  # who inserted the row and when
            return F.coalesce(before, now)
        return F.when(renewed, now).otherwise(before)

    rest = [c for c in regular_columns(known.columns) if c not in names]
    reserved = [c for c in known.columns if c not in (*names, *rest, *STAMPS, CHANGE)]
    ordered = [*names, *rest, *reserved, *STAMPS]
    return met.select(*[value(c).alias(c) for c in ordered], CHANGE)


def upsert_counts(merged: DataFrame) -> DataFrame:
    """One row with the numbers of ``inserted``, ``changed``, ``equal`` and ``gone`` keys."""
    return merged.agg(*[F.count_if(F.col(CHANGE) == c).alias(c) for c in (INSERTED, CHANGED, EQUAL, GONE)])
