"""Merging by order instead of equality: the latest row before, and the interval around."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col, comparable
from stratalift.operators.projections import exclude_row_columns

# Pairs that one piece of a hot key and bucket compares at most, and intervals it has, about.
PIECE_PAIRS = 1 << 22
PIECE_RANGES = 1 << 11


def merge_asof(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    at: str,
    other_at: str,
    bucket: str | float = "day",
    allow_equal: bool = True,
) -> DataFrame:
    """Every row of ``df`` with the columns of the latest row of ``other`` of its keys, at or before it.

    ``at`` and ``other_at`` are times or numbers. Of several latest rows the last in the order of
    all columns counts; a row without one has NULLs. Rows with a NULL key or time find
    nothing and are found by nothing. Columns of ``other`` besides the keys are added;
    ``other_at`` among them, so the two tables share no name but the keys. ``allow_equal=False``
    takes earlier rows only.

    Both sides go into one window per key and ``bucket`` (a unit that times are cut to, or the width
    of a number), which pairs no rows. What a bucket inherits from those before it is a row per
    key and bucket. So the rows of one key spread over as many tasks as it has buckets.
    """
    other = exclude_row_columns(other)
    added = [c for c in other.columns if c not in on]
    double = sorted(set(df.columns) & set(added))
    if double:
        raise ValueError(f"both sides have a column {', '.join(double)}")
    keys = [f"__key{n}" for n in range(len(on))]

    def named(source: DataFrame, time: str) -> list[Column]:
        own = [col(k).alias(name) for k, name in zip(on, keys, strict=True)]
        return [*own, col(time).alias("__at"), _bucket(col(time), source.schema[time].dataType, bucket).alias("__bucket")]

    known = F.struct(*[col(c) for c in added])
    tie = F.struct(*[comparable(col(c), other.schema[c].dataType).alias(f"t{n}") for n, c in enumerate(added)])
    right = other.select(*named(other, other_at), known.alias("__known"), tie.alias("__tie"))
    right = right.where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "__at")))
    left = df.select(*named(df, at), F.struct(*[col(c) for c in df.columns]).alias("__row"))
    both = left.unionByName(right, allowMissingColumns=True)
    # at the same time rows of the other table stand before those that look for them, or behind
    side = F.when(F.col("__row").isNotNull(), 1).otherwise(0 if allow_equal else 2)
    within = Window.partitionBy(*keys, "__bucket").orderBy("__at", side, "__tie")
    latest = F.last("__known", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("__found", latest).where(F.col("__row").isNotNull())
    ends = both.groupBy(*keys, "__bucket").agg(
        F.max_by("__known", F.when(F.col("__known").isNotNull(), F.struct("__at", "__tie"))).alias("__last"),
        F.max(F.col("__row").isNotNull()).alias("__asked"),
    )
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__before", F.last("__last", ignorenulls=True).over(earlier))
    ends = ends.where(F.col("__asked") & F.col("__before").isNotNull()).select(*keys, "__bucket", "__before")
    joined = found.join(ends, [*keys, "__bucket"], "left")
    met = F.coalesce("__found", "__before")
    return joined.select(
        *[F.col("__row")[c].alias(c) for c in df.columns], *[met[c].alias(c) for c in added]
    )


def merge_ranges(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    at: str,
    low: str,
    high: str,
    width: float,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``df`` with those of ``other`` of the same keys whose interval ``[low, high)`` holds ``at``.

    Times and numbers are cut into buckets of ``width`` (seconds for times, days for dates). An
    interval stands in every bucket that it meets, a value in one, so they are joined on keys and
    bucket and the edges are compared exactly; no pair is met twice. Choose a width near the
    length of most intervals. NULL keys, values and edges meet nothing, as do intervals
    that end where they begin. ``how`` is ``inner`` or ``left``.

    The pairs can be far more than the rows, so tasks are cut by pairs, not by the size of the tables:
    a key and bucket with more than ``PIECE_PAIRS`` of them becomes a grid of pieces of so many, each with
    about ``PIECE_RANGES`` intervals (all of them for ``left``, where a value must see them at once). That takes a
    counting pass over keys and places; the hot keys and buckets are fewer than a thousandth of the rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join kind {how!r}, expected inner or left")
    other = exclude_row_columns(other)
    double = sorted(set(df.columns) & set(other.columns) - set(on))
    if double:
        raise ValueError(f"both sides have a column {', '.join(double)}")
    own, piece = "__bucket", ["__left_piece", "__right_piece"]

    def place(name: str, source: DataFrame) -> Column:
        return F.floor(_position(col(name), source.schema[name].dataType) / width)

    keys = _same_keys(df, other, on)
    cell = [*(f"__key{n}" for n in range(len(keys))), own]
    known = " AND ".join(f"{c} IS NOT NULL" for c in cell)
    spans = other.where(col(low) < col(high)).select("*", *[k.alias(c) for (_, k), c in zip(keys, cell)])
    spans = spans.select("*", F.explode(F.sequence(place(low, other), place(high, other))).alias(own)).where(known)
    values = df.select("*", *[k.alias(c) for (k, _), c in zip(keys, cell)], place(at, df).alias(own))
    if how == "inner":
        values = values.where(known)
    hot = _pieces(values, spans, cell, how).hint("broadcast")
    values, spans = values.join(hot, cell, "left"), spans.join(hot, cell, "left")

    def spread(source: DataFrame, count: str) -> Column:
        # neither equal rows nor rows of one input partition land on one piece
        row = [comparable(col(f.name), f.dataType) for f in source.schema]
        number = F.xxhash64(*row, F.spark_partition_id())
        # rows that meet nothing may go anywhere
        return F.when(F.expr(known), F.pmod(number, F.coalesce(count, F.lit(1)))).otherwise(number)

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(count, F.lit(1)) - 1))

    mine = values.select("*", spread(df, "__lefts").alias(piece[0])).select("*", each("__rights").alias(piece[1]))
    theirs = spans.select("*", spread(other, "__rights").alias(piece[1])).select("*", each("__lefts").alias(piece[0]))
    # by number: Spark would merge the partitions of small tables, whatever their pairs
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = [*cell, *piece]
    met = mine.repartition(tasks, *places).alias("a").join(
        theirs.repartition(tasks, *places).alias("b").hint("merge"),
        [
            *[F.col(f"a.{c}") == F.col(f"b.{c}") for c in places],
            *[F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in on],
            col(at) >= col(low),
            col(at) < col(high),
        ],
        how,
    )
    added = [c for c in other.columns if c not in on]
    return met.select(*[F.col(f"a.`{c}`") for c in df.columns], *[F.col(f"b.`{c}`") for c in added])


def _same_keys(df: DataFrame, other: DataFrame, on: Sequence[str]) -> list[tuple[Column, Column]]:
    """The keys of both sides in one type. Keys that only a comparison brings together are left out."""
    keys = []
    for name in on:
        kinds = [source.schema[name].dataType for source in (df, other)]
        if kinds[0] == kinds[1]:
            keys.append((col(name), col(name)))
        elif all(isinstance(k, T.NumericType) for k in kinds):
            common = "long" if all(isinstance(k, T.IntegralType) for k in kinds) else "double"
            keys.append((col(name).cast(common), col(name).cast(common)))
    return keys


def _pieces(values: DataFrame, spans: DataFrame, cell: Sequence[str], how: str) -> DataFrame:
    """Keys and buckets with more than ``PIECE_PAIRS`` pairs, and into how many pieces either side goes."""
    both = values.select(*cell, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionAll(
        spans.select(*cell, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    counts = both.groupBy(*cell).agg(*[F.greatest(F.sum(c), F.lit(1)).cast("double").alias(c) for c in ("__l", "__r")])
    pairs = F.col("__l") * F.col("__r")
    rights = F.ceil(F.col("__r") / PIECE_RANGES) if how == "inner" else F.lit(1).cast("long")
    hot = counts.where(pairs > PIECE_PAIRS).withColumn("__rights", rights)
    lefts = F.ceil(F.least(F.col("__l"), pairs / F.col("__rights") / PIECE_PAIRS))
    return hot.select(*cell, lefts.alias("__lefts"), "__rights")


def _position(value: Column, kind: T.DataType) -> Column:
    """A number in the order of the values."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")) / 1e6
    return value


def _bucket(value: Column, kind: T.DataType, bucket: str | float) -> Column:
    if isinstance(bucket, str):
        if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"numbers need the width of a bucket, not {bucket!r}")
        return F.unix_micros(F.date_trunc(bucket, value.cast("timestamp")))
    return F.floor(_position(value, kind) / bucket)
