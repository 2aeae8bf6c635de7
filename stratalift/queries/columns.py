"""Column operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.functions import local_time_text
from stratalift.operators import (
    audit_columns,
    cast_failures,
    cast_types,
    concat_separator,
    divide,
    drop_columns,
    exclude_row_columns,
    reformat_date,
    rename_columns,
    replace_text,
    split_column,
)
from stratalift.queries.registry import query, table

RUN_TS = "2025-03-01 10:20:30.456"
RUN_BY = "Bronze Layer - Direct - tester"


@query(
    "cast_types",
    """select cast(o_orderkey as integer) as o_orderkey,
              cast(o_custkey as varchar) as o_custkey,
              o_orderstatus,
              cast(o_totalprice as decimal(18,2)) as o_totalprice,
              cast(o_orderdate as date) as o_orderdate,
              try_cast(o_orderpriority as integer) as o_orderpriority
       from orders""",
)
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_types(
        table(spark, sf_dir, "orders"),
        {
            "o_orderkey": "integer",
            "o_custkey": "string",
            "o_totalprice": "decimal(18,2)",
            "o_orderdate": "date",
            "o_orderpriority": "integer",
            "not_there": "date",
        },
    )


# JSON texts of events as they land, some of them broken or of another shape.
NESTED_TEXTS = {
    "tags": """case event_id % 11 when 0 then '[1, 2' when 1 then '{"a": 1}' when 2 then '[1, "x", null]' when 3 then null
               else concat('[', event_id % 10, ', "', user_id, '"]') end""",
    "props": """case when event_id % 5 = 0 then '{"k": "none", "n": 7}' else props end""",
    "visit": """case when event_id % 13 = 0 then 'no visit' else
                concat('{"user": ', user_id, ', "at": {"day": "', case when event_type = 'error' then 'soon' else '2024-02-0' end,
                       case when event_type = 'error' then '' else cast(event_id % 9 + 1 as varchar(1)) end, '", "value": ',
                       value, '}, "steps": [{"n": 1}, {"n": "', event_type, '"}, ', event_id % 3, '], "type": "', event_type, '"}')
                end""",
}
NESTED_SQL = f"select event_id, {', '.join(f'{text} as {name}' for name, text in NESTED_TEXTS.items())} from events"
NESTED_TYPES = {
    "tags": "array<int>",
    "props": "map<string,int>",
    "visit": "struct<user:bigint,at:struct<day:date,value:decimal(10,2)>,steps:array<struct<n:int>>,type:string>",
}
# Every path of the texts that their types name, in DuckDB's terms.
PATHS_SQL = f"""select event_id,
       case when json_valid(tags) and json_type(tags) = 'ARRAY' then tags end as tags, tags as tags_text,
       case when json_valid(props) and json_type(props) = 'OBJECT' then props end as props,
       case when json_valid(visit) and json_type(visit) = 'OBJECT' then visit end as visit, visit as visit_text
       from ({NESTED_SQL})"""


def nested_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [F.expr(text).alias(name) for name, text in NESTED_TEXTS.items()]
    return table(spark, sf_dir, "events").select("event_id", *texts)


@query(
    "cast_nested",
    f"""select event_id, cast(json_array_length(tags) as integer) as n_tags,
               try_cast(tags ->> '$[0]' as integer) as tag0, try_cast(tags ->> '$[1]' as integer) as tag1,
               try_cast(props ->> '$.k' as integer) as k, try_cast(props ->> '$.n' as integer) as n,
               try_cast(visit ->> '$.user' as bigint) as visitor, try_cast(visit ->> '$.at.day' as date) as day,
               try_cast(visit ->> '$.at.value' as decimal(10,2)) as value,
               try_cast(visit ->> '$.steps[0].n' as integer) as step0, try_cast(visit ->> '$.steps[1].n' as integer) as step1,
               visit ->> '$.type' as type
        from ({PATHS_SQL})""",
)
def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cast_types(nested_texts(spark, sf_dir), NESTED_TYPES)
    steps = F.col("visit.steps")
    return typed.select(
        "event_id",
        F.when(F.col("tags").isNotNull(), F.size("tags")).alias("n_tags"),
        F.get("tags", F.lit(0)).alias("tag0"),
        F.get("tags", F.lit(1)).alias("tag1"),
        F.col("props")["k"].alias("k"),
        F.col("props")["n"].alias("n"),
        F.col("visit.user").alias("visitor"),
        "visit.at.day",
        "visit.at.value",
        F.get(steps, F.lit(0))["n"].alias("step0"),
        F.get(steps, F.lit(1))["n"].alias("step1"),
        "visit.type",
    )


@query(
    "cast_nested_failures",
    f"""with t as ({PATHS_SQL}), counts as (select
          count(*) filter (tags_text is not null and tags is null) as "tags",
          sum(case when json_array_length(tags) > 1 and tags ->> '$[1]' is not null
                        and try_cast(tags ->> '$[1]' as integer) is null then 1 else 0 end) as "tags[]",
          count(*) filter (props is null) as "props",
          count(*) filter (try_cast(props ->> '$.k' as integer) is null and props ->> '$.k' is not null) as "props{{}}",
          count(*) filter (visit_text is not null and visit is null) as "visit",
          0 as "visit.user", 0 as "visit.at",
          count(*) filter (visit is not null and try_cast(visit ->> '$.at.day' as date) is null) as "visit.at.day",
          0 as "visit.at.value", 0 as "visit.steps", count(visit) as "visit.steps[]",
          count(*) filter (visit is not null and try_cast(visit ->> '$.steps[1].n' as integer) is null) as "visit.steps[].n",
          0 as "visit.type" from t)
        select "column", failed from
          (unpivot (select columns(*)::bigint from counts) on columns(*) into name "column" value failed)""",
)
def nested_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_failures(nested_texts(spark, sf_dir), NESTED_TYPES)


@query(
    "concat_separator",
    """select o_orderkey,
              substr(d, 1, 4) || '/' || substr(d, 5, 2) || '/' || substr(d, 7, 2) as day
       from (select o_orderkey, strftime(o_orderdate, '%Y%m%d') as d from orders)""",
)
def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_separator(_compact_days(spark, sf_dir), "day", "/", {1: 4, 5: 2, 7: 2})


@query(
    "reformat_date",
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders",
)
def reformatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = reformat_date(_compact_days(spark, sf_dir), "day")
    return reformat_date(once, "day")


def _compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    )


@query(
    "divide",
    """select l_orderkey, l_linenumber, l_tax, l_discount,
              cast(l_tax / nullif(l_discount, 0) as float) as tax_share
       from lineitem""",
)
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax", "l_discount"
    )
    return divide(lines, "tax_share", "l_tax", "l_discount")


@query(
    "divide_text",
    """select o_orderkey, try_cast(priority as double) as parsed,
              cast(o_totalprice / nullif(try_cast(priority as double), 0) as float) as share
       from (select o_orderkey, o_totalprice, case when o_orderkey % 7 = 0 then 'none'
                    else substr(o_orderpriority, 1, 1) end as priority from orders)""",
)
def ratio_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("o_orderkey") % 7 == 0, "none").otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string"), priority.alias("priority")
    )
    shares = divide(orders, "share", "o_totalprice", "priority")
    return shares.select("o_orderkey", F.expr("try_cast(priority as double)").alias("parsed"), "share")


@query(
    "split",
    """select c_custkey, c_name, string_split(c_name, '#')[1] as kind,
              string_split(c_name, '#')[2] as number, string_split(c_name, '#')[3] as absent
       from customer""",
)
def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for at, new in enumerate(("kind", "number", "absent")):
        named = split_column(named, new, "c_name", "#", at)
    return named


@query(
    "replace",
    """select c_custkey, replace(replace(c_name, 'Customer#', 'C-'), '00', '_') as c_name
       from customer""",
)
def replacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return replace_text(named, "c_name", {"Customer#": "C-", "00": "_"})


@query(
    "drop_rename",
    """select p_partkey as "RK-Part", p_name as "Part_Name", p_brand, p_size, p_retailprice
       from part""",
)
def dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_columns(table(spark, sf_dir, "part"), ["p_type", "not_there"])
    return rename_columns(kept, {"p_partkey": "RK-Part", "p_name": "Part_Name", "gone": "x"})


@query(
    "audit_columns",
    f"""select s_suppkey, s_name, s_nationkey, s_acctbal,
               timestamp '2025-03-01 10:20:30' as "Row_Inserted-On",
               '{RUN_BY}' as "Row_Inserted-By",
               timestamp '2025-03-01 10:20:30' as "Row_Updated-On",
               '{RUN_BY}' as "Row_Updated-By"
        from supplier""",
)
def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = audit_columns(table(spark, sf_dir, "supplier"), RUN_BY, RUN_TS)
    return cast_types(
        stamped, {"Row_Inserted-On": "timestamp_ntz", "Row_Updated-On": "timestamp_ntz"}
    )


@query("exclude_row_columns", "select * from supplier")
def without_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_row_columns(audit_columns(table(spark, sf_dir, "supplier"), RUN_BY, RUN_TS))


@query(
    "ph_datetime",
    """select event_id, strftime(ts + interval 8 hours, '%Y-%m-%d %I:%M:%S %p') as local_time
       from events""",
)
def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", local_time_text(F.col("ts")).alias("local_time")
    )
