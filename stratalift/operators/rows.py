"""Row operators: duplicates, order, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col, comparable, holds, narrow, regular_columns
from stratalift.staging import staged

# A page that ends within this many rows is cut by a top-k sort; a deeper one is numbered.
TOP_K_ROWS = 1_000_000
SPREAD = "__partition"


def dedupe(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    tie_break: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key; without keys, one row per value of all regular columns.

    The survivor is the first in ``tie_break`` order (``{column: ASC|DESC}``),
    further ties go by the remaining columns, so a task that runs again keeps
    the same row. Spark limits each map task to one row per key before the
    shuffle (``WindowGroupLimit``), so a key that holds a third of all rows
    sends one row per task.
    """
    by = list(keys) if keys else regular_columns(df.columns)
    rest = [c for c in df.columns if c not in by]
    plain = not any(holds(f.dataType, T.MapType, T.VariantType) for f in df.schema)
    if not rest and plain:
        return df.dropDuplicates()
    tie_break = tie_break or {}
    others = [_sortable(df, c) for c in rest or by if c not in tie_break]
    order = [*order_columns(tie_break), *others]
    first = Window.partitionBy(*[narrow(df, k) for k in by]).orderBy(*order)
    rank = "__rank"
    ranked = df.select("*", F.row_number().over(first).alias(rank))
    return ranked.where(F.col(rank) == 1).drop(rank)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return dedupe(df.select(col(column)), [column])


def order_columns(order: Mapping[str, str]) -> list[Column]:
    """``{column: ASC|DESC}``, any case; ASC puts NULLs first, DESC last; other words are ignored."""
    words = {"ASC": Column.asc, "DESC": Column.desc}
    return [words[w.upper()](col(c)) for c, w in order.items() if w.upper() in words]


def sort_multi(df: DataFrame, order: Mapping[str, str]) -> DataFrame:
    """Global sort in the declared order.

    Rows with equal keys may come in any order, so the input partition's number
    goes behind the keys: the range partitioning can then split a key that
    holds a large share of the rows over many tasks instead of one. The number
    does not depend on the order of rows within the task.
    """
    gone = [c for c in order if c not in df.columns]
    if gone:
        # Spark would still find a column that was dropped just before
        raise ValueError(f"sort columns {', '.join(gone)} do not exist")
    keys = order_columns(order)
    if not keys:
        return df
    numbered = df.select("*", F.spark_partition_id().alias(SPREAD))
    return numbered.orderBy(*keys, F.col(SPREAD)).drop(SPREAD)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)


def page_rows(
    df: DataFrame, order: Mapping[str, str], limit: int, offset: int = 0, top_k: int = TOP_K_ROWS
) -> DataFrame:
    """Rows ``offset .. offset + limit`` in the given order.

    Rows with equal keys are in the order of a hash of all their columns, so
    pages neither overlap nor leave rows out. Near the start a page is a top-k. A deep
    one would make that top-k hold all rows before it in one task; there only
    keys and hashes are sorted, range by range, to find those of the page's
    first and last row, and then the rows between them are read and sorted.
    """
    if not order_columns(order):
        raise ValueError("pages need an order")
    tie, part, at, first, size, before = "__tie", "__part", "__at", "__first", "__size", "__before"
    tied = df.select("*", F.xxhash64(*[_sortable(df, c) for c in df.columns]).alias(tie))
    directions = {c: w.upper() for c, w in order.items() if w.upper() in ("ASC", "DESC")}
    directions[tie] = "ASC"
    keys = order_columns(directions)
    end = offset + limit
    if end <= top_k:
        return tied.orderBy(*keys).offset(offset).limit(limit).drop(tie)
    ranged = tied.select(*map(col, directions)).repartitionByRange(*keys)
    with staged(ranged.select("*", F.spark_partition_id().alias(part)), "keys") as sorted_keys:
        # one row per range partition, so one window over all of them is small
        earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        sizes = sorted_keys.groupBy(part).agg(F.count(F.lit(1)).alias(size))
        starts = sizes.withColumn(before, F.coalesce(F.sum(size).over(earlier), F.lit(0)))
        met = starts.where((F.col(before) < end) & (F.col(before) + F.col(size) > offset))
        within = Window.partitionBy(part).orderBy(*keys)
        numbered = sorted_keys.join(F.broadcast(met), part).withColumns(
            {at: F.col(before) + F.row_number().over(within) - 1, first: F.col(before) + F.rank().over(within) - 1}
        )
        inside = numbered.where((F.col(at) >= offset) & (F.col(at) < end))
        row = F.struct(*map(col, directions), first)
        ends = inside.agg(F.min_by(row, at).alias("lowest"), F.max_by(row, at).alias("highest")).head()
    lowest, highest = ends["lowest"], ends["highest"]
    if lowest is None:
        return df.limit(0)
    wanted = _reaches(lowest, directions, False) & _reaches(highest, directions, True)
    # rows equal to the page's first one that are before it
    skipped = offset - lowest[first]
    return tied.where(wanted).orderBy(*keys).offset(skipped).limit(limit).drop(tie)


def _reaches(row: Row, directions: Mapping[str, str], backwards: bool) -> Column:
    """Whether a row is at or behind (``backwards``: at or before) the given one in the order."""
    condition = F.lit(True)
    for name, word in reversed(directions.items()):
        value, column = row[name], col(name)
        # NULLs are first where the order ascends and last where it descends
        nulls_lie_beyond = (word == "DESC") != backwards
        if value is None:
            beyond = F.lit(False) if nulls_lie_beyond else column.isNotNull()
        else:
            beyond = column > F.lit(value) if (word == "ASC") != backwards else column < F.lit(value)
            if nulls_lie_beyond:
                beyond = beyond | column.isNull()
        condition = F.coalesce(beyond, F.lit(False)) | (column.eqNullSafe(F.lit(value)) & condition)
    return condition


def _sortable(df: DataFrame, name: str) -> Column:
    return comparable(col(name), df.schema[name].dataType)
