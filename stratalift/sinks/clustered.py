"""A layout in which filters on several columns each skip most of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col, comparable

# Ranks of a column: 2^6, enough for thousands of files by two columns.
BITS = 6


def cluster_rows(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The rows in so many range partitions of their Z-order over the columns, sorted by it.

    Each column is cut into ranges of about equally many rows, and the bits of the ranges' numbers
    are interleaved, so that a partition is narrow in every column; sorting by one column first would
    leave the others spread over all files. Numbers, times and text (by its first bytes) can be
    cut. NULLs are in the first range. Rows of one Z-order number can be dealt to several
    partitions, so a value that holds many rows makes no long file.
    """
    number = "__z"
    ranked = df.withColumn(number, _interleaved(_ranks(df, columns)))
    # rows of one number are told apart by the values, and equal ones by all columns
    rest = F.xxhash64(*[comparable(col(f.name), f.dataType) for f in df.schema])
    order = [F.col(number), *[col(c) for c in columns], rest]
    return ranked.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(number)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, fmt: str = "parquet"
) -> None:
    """Overwrite a layer's table with its rows in that layout."""
    cluster_rows(df, columns, files).write.format(fmt).mode("overwrite").save(path)


def _ranks(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    places = [_place(col(c), df.schema[c].dataType) for c in columns]
    shares = [n / (1 << BITS) for n in range(1, 1 << BITS)]
    # one pass with bounded summaries
    bounds = df.agg(*[F.percentile_approx(p, shares, 2000).alias(f"b{n}") for n, p in enumerate(places)]).first()
    ranks = []
    for n, place in enumerate(places):
        cuts = sorted(set(bounds[f"b{n}"] or ()))
        below = F.filter(F.array(*[F.lit(c) for c in cuts]), _is_below(place)) if cuts else None
        ranks.append(F.coalesce(F.size(below), F.lit(0)) if cuts else F.lit(0))
    return [F.greatest(rank, F.lit(0)).cast("long") for rank in ranks]


def _is_below(place: Column) -> Callable[[Column], Column]:
    return lambda cut: cut < place


def _place(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _interleaved(ranks: list[Column]) -> Column:
    bits = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(ranks) + at)
        for at, rank in enumerate(ranks)
        for bit in range(BITS)
    ]
    return reduce(Column.bitwiseOR, bits)
