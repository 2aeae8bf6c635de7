"""Counts and quality profiles, each in one aggregation pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from stratalift.functions.columns import blank_match, col, narrow, regex_match
from stratalift.functions.types import cast_losses, spark_type
from stratalift.operators.filters import Tree, filter_condition
from stratalift.operators.rows import dedupe

Checks = Mapping[str, Sequence[str]]

USER_CHECK = "UserDefined:"
DISTINCT = "distinct"
AGGREGATES = {"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "COUNT": F.count}


@dataclass
class QualityPlan:
    """Aggregates to take, and how the counts of the checks come out of them.

    Exact distinct counts are kept apart from the plain ones: in one aggregation
    every distinct value would carry the sums of all others through the shuffle.
    """

    plain: dict[str, Column] = field(default_factory=dict)
    distinct: dict[str, Column] = field(default_factory=dict)
    # column, check, count as an expression over the row of ``profile``
    entries: list[tuple[str, str, Column]] = field(default_factory=list)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def quality_plan(
    df: DataFrame,
    checks: Checks,
    regexes: Mapping[str, str] | None = None,
    approx: bool = False,
) -> QualityPlan:
    """The checks of every listed, existing column."""
    plan = QualityPlan()
    for at, name in enumerate(c for c in checks if c in df.columns):
        value = col(name)
        nulls, unique = f"nulls{at}", f"unique{at}"
        plan.plain[nulls] = F.count_if(value.isNull())
        for check in checks[name]:
            if check == "Null":
                plan.entries.append((name, check, F.col(nulls)))
            elif check == "Blank":
                plan.plain[f"blank{at}"] = F.count_if(blank_match(value))
                plan.entries.append((name, check, F.col(f"blank{at}")))
            elif check == "Unique":
                if approx:
                    plan.plain[unique] = F.approx_count_distinct(narrow(df, name))
                    values = F.col(unique)
                else:
                    plan.distinct[unique] = F.count_distinct(narrow(df, name))
                    values = F.col(f"{DISTINCT}.{unique}")
                # NULL counts as one value
                values = values + F.when(F.col(nulls) > 0, 1).otherwise(0)
                plan.entries.append((name, check, values))
                plan.entries.append((name, "Duplicate", F.col("gross") - values))
            elif check.startswith(USER_CHECK):
                expression = check.removeprefix(USER_CHECK)
                if expression not in (regexes or {}):
                    raise ValueError(f"quality check {check!r} names no known expression")
                count = f"matches{len(plan.entries)}"
                plan.plain[count] = F.count_if(regex_match(value, regexes[expression]))
                plan.entries.append((name, check, F.col(count)))
            else:
                raise ValueError(f"unknown quality check {check!r}")
    return plan


def profile(df: DataFrame, plan: QualityPlan, gross: DataFrame | None = None) -> DataFrame:
    """One row with the plan's aggregates, ``rows`` and ``gross``."""
    row = df.agg(*[value.alias(name) for name, value in plain_aggregates(plan).items()])
    return with_distinct(row, df, plan, gross)


def plain_aggregates(plan: QualityPlan) -> dict[str, Column]:
    """The part of a profile that is one scan, without a shuffle of rows."""
    return {"rows": F.count(F.lit(1)), **plan.plain}


def with_distinct(
    row: DataFrame, df: DataFrame, plan: QualityPlan, gross: DataFrame | None = None
) -> DataFrame:
    """Complete a profile whose plain aggregates are known.

    Distinct counts read their columns of ``df`` in a scan of their own.
    """
    row = row.withColumn("gross", F.col("rows") if gross is None else gross.scalar())
    if plan.distinct:
        counts = df.agg(*[value.alias(name) for name, value in plan.distinct.items()])
        row = row.withColumn(DISTINCT, counts.select(F.struct("*")).scalar())
    return row


def quality_rows(row: DataFrame, plan: QualityPlan) -> DataFrame:
    """The profile as one row per column and check."""
    if not plan.entries:
        return row.sparkSession.createDataFrame([], REPORT_SCHEMA)
    return row.select(F.inline(F.array(*quality_entries(plan))))


def quality_entries(plan: QualityPlan) -> list[Column]:
    return [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(check).alias("check"),
            count.cast("bigint").alias("cnt"),
            (F.try_divide(count, F.col("gross")) * 100).alias("pct_of_gross"),
        )
        for name, check, count in plan.entries
    ]


def quality_report(
    df: DataFrame,
    checks: Checks,
    regexes: Mapping[str, str] | None = None,
    gross: DataFrame | None = None,
    approx: bool = False,
) -> DataFrame:
    """One row per column and check: ``column, check, cnt, pct_of_gross``.

    ``gross`` is a one-value frame with the row count percentages refer to, when
    that is not the frame's own (the count before duplicates were removed).
    """
    plan = quality_plan(df, checks, regexes, approx)
    return quality_rows(profile(df, plan, gross), plan)


REPORT_SCHEMA = "column string, check string, cnt bigint, pct_of_gross double"


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column the number of values that its declared type cannot hold: ``column, failed``.

    Columns whose text is read as a nested type also have a row for every path inside, as
    ``column.field``, ``column[]`` or ``column{}``.
    """
    counts = cast_failed_counts(df, {c: t for c, t in types.items() if c in df.columns})
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, failed bigint")
    row = df.agg(*[count.alias(f"failed{at}") for at, count in enumerate(counts.values())])
    entries = [
        F.struct(F.lit(path).alias("column"), F.col(f"failed{at}").alias("failed")) for at, path in enumerate(counts)
    ]
    return row.select(F.inline(F.array(*entries)))


def cast_failed_counts(df: DataFrame, types: Mapping[str, str]) -> dict[str, Column]:
    """Aggregates: the values that each path of the typed columns loses."""
    return {
        f"{c}{path}": count
        for c, t in types.items()
        for path, count in cast_failed(col(c), df.schema[c].dataType, t).items()
    }


def cast_failed(
    value: Column, source: DataType, type_name: str, among: Column | None = None
) -> dict[str, Column]:
    """Aggregates by path: values (of the rows ``among``) that the named type cannot hold."""
    each = cast_losses(value, source, spark_type(type_name))
    return {
        path: F.coalesce(F.sum(lost if among is None else F.when(among, lost)), F.lit(0))
        for path, lost in each.items()
    }


def row_reconciliation(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    tie_break: Mapping[str, str] | None = None,
    tree: Tree | None = None,
) -> DataFrame:
    """What duplicate removal and filter did: ``gross, duplicates, filtered, net`` in one row.

    ``filtered`` counts against the rows that reached the filter, so the four
    add up: ``gross = duplicates + filtered + net``.
    """
    unique = dedupe(df, keys, tie_break)
    kept = filter_condition(df, tree) if tree else F.lit(True)
    counts = unique.agg(F.count(F.lit(1)).alias("__unique"), F.count_if(kept).alias("net"))
    return (
        counts.withColumn("gross", row_count(df).scalar())
        .withColumn("duplicates", F.col("gross") - F.col("__unique"))
        .withColumn("filtered", F.col("__unique") - F.col("net"))
        .select("gross", "duplicates", "filtered", "net")
    )


def group_agg(df: DataFrame, by: Sequence[str], aggs: Mapping[str, str]) -> DataFrame:
    """``{"field:alias": "SUM"}`` per group; without an alias the field keeps its name."""
    outputs: list[Any] = []
    for target, word in aggs.items():
        field, _, alias = target.partition(":")
        if word.upper() not in AGGREGATES:
            raise ValueError(f"unknown aggregate {word!r}, expected one of {', '.join(AGGREGATES)}")
        outputs.append(AGGREGATES[word.upper()](col(field)).alias(alias or field))
    return df.groupBy(*[col(c) for c in by]).agg(*outputs)
