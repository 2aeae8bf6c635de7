"""Column operators: each is one ``select`` over the input, so Catalyst folds a chain into one."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col, regular_columns, reserved_columns
from stratalift.functions.types import fitting_cast, spark_type

# The audit columns in their order.
STAMPS = ("Row_Inserted-On", "Row_Inserted-By", "Row_Updated-On", "Row_Updated-By")
COMPACT_DATE = r"^\d{8}$"
# Start and length of year, month and day in a yyyyMMdd text.
COMPACT_DATE_PARTS = {1: 4, 5: 2, 7: 2}


def with_expressions(df: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """Replace existing columns in place, keeping the column order."""
    return df.select(*[expressions.get(c, col(c)).alias(c) for c in df.columns])


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast each named, existing column; a value that does not fit becomes NULL."""
    return with_expressions(
        df,
        {
            c: fitting_cast(col(c), df.schema[c].dataType, spark_type(t))
            for c, t in types.items()
            if c in df.columns
        },
    )


def concat_separator(df: DataFrame, column: str, sep: str, parts: Mapping[int, int]) -> DataFrame:
    """Rebuild a text column from substrings ``{start: length}`` joined with ``sep``."""
    return with_expressions(df, {column: pieces(col(column), sep, parts)})


def reformat_date(df: DataFrame, column: str) -> DataFrame:
    """``yyyyMMdd`` text to ``yyyy-MM-dd``; any other text is left as it is, so a rerun is safe."""
    return with_expressions(df, {column: compact_date(col(column))})


def replace_text(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace literal substrings, in the order of the mapping."""
    return with_expressions(df, {column: replaced(col(column), mapping)})


def pieces(value: Column, sep: str, parts: Mapping[int, int]) -> Column:
    cut = [F.substring(value, start, length) for start, length in parts.items()]
    # concat_ws would turn a NULL value into an empty text
    return F.when(value.isNotNull(), F.concat_ws(sep, *cut))


def compact_date(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.rlike(COMPACT_DATE), pieces(text, "-", COMPACT_DATE_PARTS)).otherwise(text)


def replaced(value: Column, mapping: Mapping[str, str]) -> Column:
    for old, new in mapping.items():
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def divide(df: DataFrame, new: str, numerator: str, denominator: str) -> DataFrame:
    """Add ``numerator / denominator`` as float; a zero denominator gives NULL.

    Text is read as double, and what does not read as one gives NULL. An
    existing column of that name is kept and nothing is added.
    """
    if new in df.columns:
        return df
    top, bottom = (
        fitting_cast(col(c), T.StringType(), T.DoubleType())
        if df.schema[c].dataType == T.StringType()
        else col(c)
        for c in (numerator, denominator)
    )
    ratio = F.try_divide(top, bottom).cast("float")
    return df.select("*", ratio.alias(new))


def split_column(df: DataFrame, new: str, column: str, sep: str, index: int) -> DataFrame:
    """Add part ``index`` (from 0) of the text split on a literal separator; NULL if absent."""
    if new in df.columns:
        return df
    # split takes a pattern, the separator is plain text
    part = F.get(F.split(col(column), re.escape(sep)), F.lit(index))
    return df.select("*", part.alias(new))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the columns that exist."""
    gone = set(columns)
    return df.select(*[col(c) for c in df.columns if c not in gone])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; two columns of one name afterwards is an error."""
    target = [names.get(c, c) for c in df.columns]
    double = sorted({t for t in target if target.count(t) > 1})
    if double:
        raise ValueError(f"rename gives more than one column named {', '.join(double)}")
    return df.select(*[col(c).alias(t) for c, t in zip(df.columns, target, strict=True)])


def audit_columns(df: DataFrame, run_by: str, run_ts: datetime | str | None = None) -> DataFrame:
    """Stamp who and when (cut to seconds) as the last columns, replacing older stamps."""
    moment = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    moment = F.date_trunc("second", moment)
    stamps = dict(zip(STAMPS, (moment, F.lit(run_by), moment, F.lit(run_by)), strict=True))
    kept = [col(c) for c in audit_last(df).columns if c not in stamps]
    return df.select(*kept, *[value.alias(name) for name, value in stamps.items()])


def audit_last(df: DataFrame) -> DataFrame:
    """Regular columns first, then the ``Row_`` columns."""
    order = regular_columns(df.columns) + reserved_columns(df.columns)
    return df.select(*[col(c) for c in order])


def exclude_row_columns(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in regular_columns(df.columns)])
