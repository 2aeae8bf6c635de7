"""The source layer of a table that a paged API serves."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from stratalift.functions.columns import col
from stratalift.operators.projections import compact_date
from stratalift.plans.layers import CustomLayer, Layer
from stratalift.plans.spec import TableSpec
from stratalift.sources.paged import PAUSE_SECONDS, read_pages


def landing_layer(
    spec: TableSpec,
    source: type[DataSource],
    run_date: date | str,
    landed: Layer | None = None,
    date_column: str | None = None,
    pause: float = PAUSE_SECONDS,
) -> CustomLayer:
    """The layer ``DS``: the days, lists and page size the spec asks the API for.

    The last day is the spec's, or ``run_date``. Without a first day only days
    after the newest one in ``landed`` are asked for, up to the day before
    ``run_date``; there may be none, and then no request is made. Without rows
    in ``landed`` the report has no first day.
    """
    run_day = date.fromisoformat(str(run_date))

    def read(spark: SparkSession) -> DataFrame:
        start, end = spec.start_date, spec.end_date or str(run_day)
        if start is None and landed is not None:
            end = spec.end_date or str(run_day - timedelta(days=1))
            newest = _newest_day(landed.read(spark), date_column)
            start = newest and str(newest + timedelta(days=1))
            if start and start > end:
                nothing = ", ".join(f"`{name}` string" for name in spec.landing_order)
                return spark.createDataFrame([], nothing)
        return read_pages(
            spark,
            source,
            spec.fetch_limit,
            spec.fetch_offset,
            pause,
            spec.in_lists,
            start,
            end,
        )

    return CustomLayer(reader=read)


def _newest_day(df: DataFrame, date_column: str) -> date | None:
    """The newest date of a landed column, as ``yyyyMMdd`` or ``yyyy-MM-dd`` text or a date."""
    day = compact_date(col(date_column)).try_cast("date")
    return df.agg(F.max(day)).first()[0]
