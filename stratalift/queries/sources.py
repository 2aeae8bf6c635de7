"""Sources: layers, windows, report requests and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.queries.registry import query, table, table_path
from stratalift.sources import (
    date_window,
    dimension_in_list,
    incremental_window,
    non_empty,
    read_layer,
    report_query,
    string_landing,
)


@query("layer_scan", "select * from orders")
def layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, table_path(sf_dir, "orders"))


@query("non_empty_guard", "select doc_id, lang from documents")
def guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return non_empty(table(spark, sf_dir, "documents").select("doc_id", "lang"))


@query(
    "date_window",
    """select event_id, ts, event_type from events
       where cast(ts as date) between date '2024-01-03' and date '2024-01-10'""",
)
def window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return date_window(events, "ts", "2024-01-03", "2024-01-10")


@query(
    "incremental_window",
    """select event_id, ts, event_type from events
       where cast(ts as date) > (select max(cast(ts as date)) from events
                                 where ts < timestamp '2024-01-08 12:00:00')
         and cast(ts as date) <= date '2024-01-20'""",
)
def increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    landed = events.where(F.col("ts") < F.lit("2024-01-08 12:00:00").cast("timestamp_ntz"))
    return incremental_window(events, landed, "ts", hi="2024-01-20")


@query(
    "incremental_window_first_load",
    "select event_id, ts from events where cast(ts as date) between '2024-01-05' and '2024-01-20'",
)
def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    nothing = events.where("false")
    return incremental_window(events, nothing, "ts", hi="2024-01-20", start="2024-01-05")


def _landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose day is text, as an API lands it."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("day"), "event_type"
    )


LANDED_EVENTS_SQL = "select event_id, strftime(ts, '%Y%m%d') as day, event_type from events"


@query(
    "date_window_text",
    f"select * from ({LANDED_EVENTS_SQL}) where day between '20240103' and '20240110'",
)
def text_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _landed_events(spark, sf_dir)
    return date_window(events, "day", "2024-01-03", "2024-01-10", text_format="yyyyMMdd")


@query(
    "incremental_window_text",
    f"""select * from ({LANDED_EVENTS_SQL})
        where day > (select max(day) from ({LANDED_EVENTS_SQL}) where day < '20240109')
          and day <= '20240120'""",
)
def text_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _landed_events(spark, sf_dir)
    landed = events.where("day < '20240109'")
    return incremental_window(events, landed, "day", hi="2024-01-20", text_format="yyyyMMdd")


@query(
    "string_landing",
    """select c_name, c_mktsegment, cast(c_custkey as varchar) as c_custkey,
              cast(c_nationkey as varchar) as c_nationkey from customer""",
)
def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_landing(
        table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"], ["c_custkey", "c_nationkey"]
    )


@query(
    "dimension_in_list",
    """select event_id, user_id, event_type from events
       where event_type in ('click', 'view') and user_id in (1, 5, 8)""",
)
def in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return dimension_in_list(events, {"event_type": ["click", "view"], "user_id": [1, 5, 8]})


REPORT_SQL = """select cast(ts as date) as day, event_type, count(*) as events,
                       count(distinct user_id) as users, round(sum(value), 2) as total
                from events
                where cast(ts as date) between date '2024-01-02' and date '2024-01-25'
                  and event_type in ('click', 'view', 'purchase')
                group by cast(ts as date), event_type"""


def _report(spark: SparkSession, sf_dir: str, limit: int | None, offset: int) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return report_query(
        events,
        ["day", "event_type"],
        {
            "events": F.count(F.lit(1)),
            "users": F.count_distinct("user_id"),
            "total": F.round(F.sum("value"), 2),
        },
        "ts",
        "2024-01-02",
        "2024-01-25",
        {"event_type": ["click", "view", "purchase"]},
        limit,
        offset,
    )


@query("report_query", REPORT_SQL)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, None, 0)


@query("report_query_page", REPORT_SQL + " order by day, event_type limit 10 offset 5")
def report_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, 10, 5)
