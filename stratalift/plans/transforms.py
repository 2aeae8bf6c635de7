"""The transform of a spec, as one lazy chain of projections around a filter and a sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from stratalift.functions.columns import col
from stratalift.operators.filters import filter_tree
from stratalift.operators.projections import (
    cast_types,
    compact_date,
    divide,
    drop_columns,
    pieces,
    rename_columns,
    replaced,
    split_column,
    with_expressions,
)
from stratalift.operators.rows import sort_multi
from stratalift.plans.spec import TableSpec


@dataclass(frozen=True)
class Changes:
    """Which columns a transform touches."""

    added: list[str] = field(default_factory=list)
    purged: list[str] = field(default_factory=list)
    updated: list[str] = field(default_factory=list)
    renamed: dict[str, str] = field(default_factory=dict)


def transform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Filter, update, cast, add, drop, sort, rename: in this order.

    So the filter sees values as they were read, filter and sort use the
    original names, and sorting by a dropped column is an error.
    """
    if spec.filter:
        df = filter_tree(df, spec.filter)
    df = with_expressions(df, updates(df.columns, spec))
    df = cast_types(df, {c.name: c.type for c in spec.columns})
    for new, ratio in spec.divide.items():
        for numerator, denominator in ratio.items():
            df = divide(df, new, numerator, denominator)
    for new, splits in spec.split.items():
        for sep, parts in splits.items():
            for column, index in parts.items():
                df = split_column(df, new, column, sep, index)
    df = drop_columns(df, [c.name for c in spec.columns if c.drop])
    df = sort_multi(df, spec.sort)
    return rename_columns(df, {c.name: c.rename for c in spec.columns if c.rename})


def updates(columns: Sequence[str], spec: TableSpec) -> dict[str, Column]:
    """The new value of every existing column that an update names."""
    values: dict[str, Column] = {}
    for name in spec.compact_dates:
        values[name] = compact_date(col(name))
    for name, separators in spec.concat_separator.items():
        for sep, parts in separators.items():
            values[name] = pieces(values.get(name, col(name)), sep, parts)
    for name, mapping in spec.replace.items():
        values[name] = replaced(values.get(name, col(name)), mapping)
    return {name: value for name, value in values.items() if name in columns}


def changes(columns: Sequence[str], spec: TableSpec) -> Changes:
    added = [n for n in (*spec.divide, *spec.split) if n not in columns]
    purged = [c.name for c in spec.columns if c.drop and c.name in columns]
    left = {*columns, *added} - {*purged}
    return Changes(
        added=list(dict.fromkeys(added)),
        purged=purged,
        updated=list(updates(columns, spec)),
        renamed={c.name: c.rename for c in spec.columns if c.rename and c.name in left},
    )
