"""Reading layer tables and the windows and lists a source is cut to."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col
from stratalift.sinks.layers import RUN_DATE, current_path, dated_path
from stratalift.staging import list_folder

Day = date | str | None


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer's table; nothing is counted or cached, so filters and columns reach the scan.

    Of a published layer the current version is read.
    """
    return spark.read.format(fmt).load(current_path(spark, path))


def read_dated(
    spark: SparkSession, path: str, run_date: Day = None, fmt: str = "parquet"
) -> DataFrame:
    """One day of a table kept by run date; without a date the latest day.

    The day's own folder is read, with the columns and types of that day. A day
    that was never written has no rows, and the columns of the latest day.
    """
    days = run_dates(spark, path)
    if not days:
        raise ValueError(f"no {RUN_DATE} folder in {path}")
    latest = max(days)
    day = latest if run_date is None else str(date.fromisoformat(str(run_date)))
    if day in days:
        return read_layer(spark, dated_path(path, day), fmt)
    return read_layer(spark, dated_path(path, latest), fmt).limit(0)


def run_dates(spark: SparkSession, path: str) -> list[str]:
    names = list_folder(spark, path)
    return [name.partition("=")[2] for name in names if name.startswith(RUN_DATE + "=")]


def date_window(
    df: DataFrame, column: str, lo: Day, hi: Day = None, text_format: str | None = None
) -> DataFrame:
    """Rows dated ``lo`` to ``hi``, both inclusive; no ``hi`` means today.

    The column is compared bare with the start of ``lo`` and of the day after
    ``hi``, so the range is pushed to the scan whatever its time type. A text
    column needs the format of its dates (``yyyyMMdd``, ``yyyy-MM-dd``), whose texts must be
    in the order of the days; the bounds are then written in it.
    """
    return df.where(_in_days(df, column, _day(lo), _day(hi), text_format))


def incremental_window(
    df: DataFrame,
    landed: DataFrame,
    column: str,
    hi: Day = None,
    start: Day = None,
    text_format: str | None = None,
) -> DataFrame:
    """Rows dated from the day after the newest landed one up to ``hi`` (default yesterday).

    With nothing landed the window starts at ``start``, or is open. When the
    landed table is up to date the window is empty. Text columns, here and in the
    landed table, hold dates of ``text_format``.
    """
    newest = F.max(col(column))
    if isinstance(landed.schema[column].dataType, T.StringType):
        newest = F.try_to_timestamp(newest, F.lit(_checked(landed, column, text_format)))
    following = F.date_add(newest.cast("date"), 1)
    first = F.coalesce(following, _day(start) if start else F.lit("0001-01-01").cast("date"))
    # a scalar subquery: runs once, before the scan it bounds
    bound = landed.agg(_as_bound(df, column, first, text_format).alias("first")).scalar()
    last = _day(hi) if hi else F.date_sub(F.current_date(), 1)
    return df.where((col(column) >= bound) & _before_end(df, column, last, text_format))


def _day(day: Day) -> Column:
    return F.current_date() if day is None else F.lit(str(day)).cast("date")


def _checked(df: DataFrame, column: str, text_format: str | None) -> str:
    if text_format is None:
        raise ValueError(f"{column} is text: declare the format of its dates")
    if not re.fullmatch(r"yyyy\W?MM\W?dd", text_format):
        raise ValueError(f"texts of format {text_format!r} are not in the order of their days")
    return text_format


def _as_bound(df: DataFrame, column: str, day: Column, text_format: str | None) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.date_format(day, _checked(df, column, text_format))
    return day.cast(kind)


def _in_days(
    df: DataFrame, column: str, lo: Column, hi: Column, text_format: str | None
) -> Column:
    lower = col(column) >= _as_bound(df, column, lo, text_format)
    return lower & _before_end(df, column, hi, text_format)


def _before_end(df: DataFrame, column: str, hi: Column, text_format: str | None) -> Column:
    return col(column) < _as_bound(df, column, F.date_add(hi, 1), text_format)


def dimension_in_list(df: DataFrame, in_lists: Mapping[str, Iterable[Any]]) -> DataFrame:
    """Rows whose fields are all in their lists; values compare as text, as an API takes them."""
    for field, values in in_lists.items():
        texts = sorted(str(v) for v in values)
        df = df.where(col(field).cast("string").isin(texts))
    return df


def string_landing(df: DataFrame, dims: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The landing shape: dimensions, then metrics, every value as text."""
    return df.select(*[col(c).cast("string").alias(c) for c in (*dims, *metrics)])


def non_empty(df: DataFrame) -> DataFrame:
    """The frame itself; raises when it has no row (reads at most one)."""
    if df.isEmpty():
        raise ValueError("no rows found")
    return df
