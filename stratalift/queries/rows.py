"""Duplicates, order and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalift.operators import dedupe, distinct_values, page_rows, preview, sort_multi
from stratalift.queries.registry import query, table
from stratalift.staging import stage_rows


@query("dedupe_all", "select distinct user_id, event_type from events")
def unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query(
    "dedupe_all_keeps_audit",
    """select user_id, event_type, min(event_id) as "Row_Event" from events
       group by user_id, event_type""",
)
def unique_rows_with_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(
        table(spark, sf_dir, "events").select(
            "user_id", "event_type", F.col("event_id").alias("Row_Event")
        )
    )


@query(
    "dedupe_keys",
    """select * from documents
       qualify row_number() over (partition by text order by doc_id) = 1""",
)
def unique_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "documents"), ["text"], {"doc_id": "ASC"})


@query(
    "dedupe_latest",
    """select * from events
       qualify row_number() over (
           partition by user_id, event_type order by ts desc nulls last, event_id) = 1""",
)
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(
        table(spark, sf_dir, "events"),
        ["user_id", "event_type"],
        {"ts": "DESC", "event_id": "ASC"},
    )


@query("distinct_values", "select distinct lang from documents")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "documents"), "lang")


@query(
    "sort_multi",
    """select event_id, event_type, value, row_number() over (
           order by event_type asc nulls first, value desc nulls last, event_id) as place
       from events""",
)
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with their place in the order they come in: that in the partition, and the
    rows of the partitions before it."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    order = {"event_type": "asc", "value": "DESC", "event_id": "ASC"}
    numbered = sort_multi(events, order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    staged = stage_rows(numbered, "sorted")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    starts = sizes.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    placed = staged.join(starts, "part")
    return placed.select(
        *("event_id", "event_type", "value"),
        (F.col("before") + F.col("at") - F.col("first") + 1).alias("place"),
    )


@query(
    "preview",
    """select event_id, kind, value
       from (select event_id, nullif(event_type, 'error') as kind, value from events)
       order by kind asc nulls first, value desc nulls last, event_id asc limit 20""",
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"), "value"
    )
    order = {"kind": "ASC", "value": "DESC", "event_id": "ASC"}
    return preview(sort_multi(events, order), 20)


@query(
    "page_rows_deep",
    "select * from events order by ts, event_id limit 300 offset 400",
)
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return page_rows(events, {"ts": "ASC", "event_id": "ASC"}, 300, 400, top_k=100)
