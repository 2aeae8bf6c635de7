"""Report requests: metrics by dimensions over a window of an event table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame

from stratalift.functions.columns import col
from stratalift.operators.rows import page_rows
from stratalift.sources.layers import Day, date_window, dimension_in_list


def report_query(
    df: DataFrame,
    dims: Sequence[str],
    metrics: Mapping[str, Column],
    date_col: str,
    lo: Day,
    hi: Day = None,
    in_lists: Mapping[str, Iterable[Any]] | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """The metrics (``{name: aggregate}``) by ``dims`` for the dates and lists asked for.

    ``limit`` and ``offset`` cut one page out of the groups, ordered by their
    dimensions, which is a total order; without a limit all groups come back.
    """
    rows = dimension_in_list(date_window(df, date_col, lo, hi), in_lists or {})
    groups = rows.groupBy(*[col(d) for d in dims]).agg(
        *[value.alias(name) for name, value in metrics.items()]
    )
    if limit is None:
        return groups
    return page_rows(groups, {d: "ASC" for d in dims}, limit, offset)
