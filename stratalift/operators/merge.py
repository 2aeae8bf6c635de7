"""Combining a table with other sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.functions.columns import col
from stratalift.operators.metrics import row_count
from stratalift.operators.projections import exclude_row_columns

HOWS = ("inner", "left", "semi", "anti")
# A key is hot above this share of the rows, so fewer than 1 / share keys can be.
HOT_SHARE = 0.001


def merge_rows(df: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all sources, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, df)


def merge_sources(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join on equal keys (``inner``, ``left``, ``semi``, ``anti``).

    No side is hinted: Spark broadcasts one when its statistics, or the size
    its shuffle turned out to have, are below the session's threshold, and
    splits skewed partitions at run time. ``salts`` also spreads the keys that
    hold over a thousandth of ``df``'s rows over that many sub-keys, at the price
    of counting passes over the key columns. Audit columns of ``other`` are left out.
    """
    if how not in HOWS:
        raise ValueError(f"unknown join kind {how!r}, expected one of {', '.join(HOWS)}")
    on = list(on)
    other = exclude_row_columns(other)
    if how in ("semi", "anti"):
        # not made distinct: an aggregate below the join would keep Spark from splitting hot keys
        other = other.select(*[col(c) for c in on])
    double = sorted(set(df.columns) & set(other.columns) - set(on))
    if double:
        raise ValueError(f"both sources have a column {', '.join(double)}")
    if not salts or salts < 2:
        return df.join(other, on, how)
    salt, mark = "__salt", "__hot"
    hot = _hot_keys(df, on).withColumn(mark, F.lit(True))
    # Neither equal rows nor rows of one input partition land on one salt.
    rest = [col(c) for c in df.columns if c not in on]
    spread = F.pmod(F.xxhash64(*rest, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = _flag(df, hot, on, mark)
    left = left.withColumn(salt, F.when(F.col(mark), spread).otherwise(0)).drop(mark)
    copies = F.when(F.col(mark), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = _flag(other, hot, on, mark).withColumn(salt, F.explode(copies)).drop(mark)
    return left.join(right, [*on, salt], how).drop(salt)


def _hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys with more than a share of all rows, hence fewer than ``1 / HOT_SHARE`` of them."""
    counts = df.groupBy(*[col(c) for c in on]).agg(F.count(F.lit(1)).alias("__rows"))
    total = row_count(df).scalar()
    return counts.where(F.col("__rows") > total * HOT_SHARE).drop("__rows")


def _flag(df: DataFrame, hot: DataFrame, on: Sequence[str], mark: str) -> DataFrame:
    renamed = hot.select(*[col(c).alias(f"__hot_{c}") for c in on], mark)
    same: Column = reduce(
        lambda a, b: a & b, [col(c).eqNullSafe(col(f"__hot_{c}")) for c in on]
    )
    flagged = df.join(F.broadcast(renamed), same, "left")
    return flagged.select(*[col(c) for c in df.columns], F.coalesce(mark, F.lit(False)).alias(mark))
