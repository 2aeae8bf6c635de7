"""What is kept between runs: trees of digests, known rows, states of groups, landed arrivals."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.operators import (
    dedupe,
    digest_tree,
    distinct_values,
    merge_asof,
    merge_ranges,
    merge_sources,
    read_tree,
    row_checksum,
    row_differences,
    upsert,
    upsert_counts,
    write_tree,
)
from stratalift.plans.sketches import keep_sketches, unique_over
from stratalift.plans.states import keep_states, kept_group_agg
from stratalift.queries.registry import query, table
from stratalift.sinks import publish_layer, write_bucketed, write_clustered
from stratalift.sources import read_layer
from stratalift.staging import staging_path
from stratalift.streaming import land_arrivals, read_arrivals

# The orders of a later day: some are gone, some have another price or status, some are new.
LATER_SQL = """select o_orderkey, o_custkey, case when o_orderkey % 101 = 0 then 'X' else o_orderstatus end as o_orderstatus,
                      case when o_orderkey % 89 = 0 then null else o_totalprice end as o_totalprice
               from orders where o_orderkey % 97 <> 0
               union all select o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice
               from orders where o_orderkey % 103 = 0"""
BOTH_SQL = f"""select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, a.o_orderkey as a_key, b.o_orderkey as b_key,
                      (a.o_custkey, a.o_orderstatus, a.o_totalprice) is not distinct from
                      (b.o_custkey, b.o_orderstatus, b.o_totalprice) as same, b.* exclude (o_orderkey),
                      a.o_custkey as a_custkey, a.o_orderstatus as a_status, a.o_totalprice as a_price
               from orders a full join ({LATER_SQL}) b on a.o_orderkey = b.o_orderkey"""


def _now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _later(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _now(spark, sf_dir)
    key = F.col("o_orderkey")
    changed = orders.where(key % 97 != 0).withColumns(
        {
            "o_orderstatus": F.when(key % 101 == 0, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(key % 89 != 0, F.col("o_totalprice")),
        }
    )
    return changed.unionByName(orders.where(key % 103 == 0).withColumn("o_orderkey", key + 100_000_000))


@query(
    "layer_row_differences",
    f"""select o_orderkey, case when b_key is null then 'only left' when a_key is null then 'only right' else 'changed' end as kind,
               (a_key is not null)::bigint as left_rows, (b_key is not null)::bigint as right_rows
        from ({BOTH_SQL}) where not same or a_key is null or b_key is null""",
)
def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both trees are kept and read back before they are compared."""
    tables = [_now(spark, sf_dir), _later(spark, sf_dir)]
    trees = []
    for side in tables:
        path = staging_path(spark, "tree")
        write_tree(digest_tree(side, ["o_orderkey"]), path)
        trees.append(read_tree(spark, path))
    return row_differences(*tables, ["o_orderkey"], *trees)


FIRST, SECOND = ("2025-03-01 10:20:30", "day one"), ("2025-03-02 11:22:33", "day two")


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = upsert(None, _now(spark, sf_dir), ["o_orderkey"], FIRST[1], FIRST[0]).drop("Row_Change")
    return upsert(known, _later(spark, sf_dir), ["o_orderkey"], SECOND[1], SECOND[0])


@query(
    "upsert_rows",
    f"""select o_orderkey, case when b_key is null then a_custkey else o_custkey end as o_custkey,
               case when b_key is null then a_status else o_orderstatus end as o_orderstatus,
               case when b_key is null then a_price else o_totalprice end as o_totalprice,
               case when a_key is null then timestamp '{SECOND[0]}' else timestamp '{FIRST[0]}' end as "Row_Inserted-On",
               case when a_key is null then '{SECOND[1]}' else '{FIRST[1]}' end as "Row_Inserted-By",
               case when b_key is null or (same and a_key is not null) then timestamp '{FIRST[0]}'
                    else timestamp '{SECOND[0]}' end as "Row_Updated-On",
               case when b_key is null or (same and a_key is not null) then '{FIRST[1]}' else '{SECOND[1]}' end as "Row_Updated-By",
               case when a_key is null then 'inserted' when b_key is null then 'gone'
                    when same then 'equal' else 'changed' end as "Row_Change"
        from ({BOTH_SQL})""",
)
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = ("Row_Inserted-On", "Row_Updated-On")
    return _upserted(spark, sf_dir).withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in stamps})


@query(
    "upsert_counts",
    f"""select count(*) filter (a_key is null) as inserted,
               count(*) filter (a_key is not null and b_key is not null and not same) as changed,
               count(*) filter (a_key is not null and b_key is not null and same) as equal,
               count(*) filter (b_key is null) as gone from ({BOTH_SQL})""",
)
def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_counts(_upserted(spark, sf_dir))


@query("publish_upsert", f"select o_orderkey, o_custkey, o_orderstatus, o_totalprice from ({LATER_SQL})")
def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer that is merged into itself: the new version reads the one it replaces."""
    path = staging_path(spark, "published")
    publish_layer(upsert(None, _now(spark, sf_dir), ["o_orderkey"], *FIRST[::-1]).drop("Row_Change"), path)
    merged = upsert(read_layer(spark, path), _later(spark, sf_dir), ["o_orderkey"], *SECOND[::-1], keep_gone=False)
    publish_layer(merged.drop("Row_Change"), path)
    return read_layer(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


BY = ["l_returnflag", "l_linestatus"]
AGGS = {
    "l_linenumber:numbers": "SUM", "l_linenumber:number": "AVG", "price:revenue": "SUM", "price:mean_price": "AVG",
    "l_shipdate:first_ship": "MIN", "l_shipdate:last_ship": "MAX", "l_orderkey:lines": "COUNT",
}


@query(
    "group_agg_kept",
    """select l_returnflag, l_linestatus, cast(sum(l_linenumber) as bigint) as numbers, avg(l_linenumber) as number,
              cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue,
              round(avg(cast(l_extendedprice as decimal(18,2))), 4) as mean_price,
              min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, count(l_orderkey) as lines
       from lineitem group by l_returnflag, l_linestatus""",
)
def kept_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days, of which the second was kept wrong at first and is replaced."""
    lines = table(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    path, day = staging_path(spark, "states"), F.col("l_orderkey") % 3
    keep_states(lines.where(day == 0), path, "2025-03-01", BY, AGGS)
    keep_states(lines.where(day != 0), path, "2025-03-02", BY, AGGS)
    keep_states(lines.where(day == 1), path, "2025-03-02", BY, AGGS)
    keep_states(lines.where(day == 2), path, "2025-03-03", BY, AGGS)
    found = kept_group_agg(spark, path, BY, AGGS)
    return found.withColumns({"revenue": F.col("revenue").cast("double"), "mean_price": F.round(F.col("mean_price").cast("double"), 4)})


@query("incremental_stream", "select o_orderkey, o_orderdate, o_totalprice from orders where o_orderstatus <> 'P'")
def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals, the last of them the oldest days, and a run of its own after each."""
    source, target, checkpoint = (staging_path(spark, name) for name in ("arriving", "landed", "progress"))
    orders = table(spark, sf_dir, "orders")
    for days in ("year(o_orderdate) > 1999", "year(o_orderdate) between 1997 and 1999", "year(o_orderdate) < 1997"):
        orders.where(days).write.mode("append").parquet(source)
        land_arrivals(spark, source, target, checkpoint, shape=lambda df: df.where("o_orderstatus <> 'P'"))
    return read_arrivals(spark, target).select("o_orderkey", "o_orderdate", "o_totalprice")


# A third of all orders are of one user.
ASKED_SQL = """select o_orderkey, case when o_orderkey % 3 = 0 then 0 else o_custkey % 150 end as user_id,
                      timestamp '2024-01-01 00:00:00' + interval 1 second * cast(o_orderkey % 2592000 as integer) as asked
               from orders"""


@query(
    "merge_asof",
    f"""select a.o_orderkey, a.user_id, a.asked, e.event_id, e.ts, e.event_type from ({ASKED_SQL}) a
        asof left join events e on a.user_id = e.user_id and a.asked >= e.ts""",
)
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 3 == 0, 0).otherwise(F.col("o_custkey") % 150).cast("long").alias("user_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=key % 2592000)).alias("asked"),
    )
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return merge_asof(orders, events, ["user_id"], "asked", "ts")


@query(
    "merge_ranges",
    """select c_custkey, c_nationkey as nation, c_acctbal, s_suppkey, floor_ as low, floor_ + 2000 as high from customer join
         (select s_suppkey, s_nationkey, s_acctbal as floor_ from supplier) on c_nationkey = s_nationkey
         and c_acctbal >= floor_ and c_acctbal < floor_ + 2000""",
)
def near_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    bands = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("low"),
        (F.col("s_acctbal") + 2000).alias("high"),
    )
    return merge_ranges(customers, bands, ["nation"], "c_acctbal", "low", "high", 1000)


# Maps with the same entries in either order.
MAPS_SQL = """select event_id, user_id, event_type, cast(props ->> '$.k' as integer) as k from events"""


def _with_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, its map built in one order and in the other."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    entries = [F.lit("type"), F.col("event_type"), F.lit("k"), F.col("k").cast("string")]
    either = [F.create_map(*entries), F.create_map(*entries[2:], *entries[:2])]
    return events.select("user_id", F.explode(F.array(*map(F.struct, either))).alias("m")).select("user_id", "m.*").toDF("user_id", "traits")


@query(
    "dedupe_maps",
    f"select distinct user_id, k, event_type from ({MAPS_SQL})",
)
def unique_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = dedupe(_with_maps(spark, sf_dir))
    return unique.select("user_id", F.col("traits")["k"].cast("int").alias("k"), F.col("traits")["type"].alias("event_type"))


@query(
    "distinct_maps",
    f"select distinct k, event_type from ({MAPS_SQL})",
)
def distinct_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = distinct_values(_with_maps(spark, sf_dir), "traits")
    return found.select(F.col("traits")["k"].cast("int").alias("k"), F.col("traits")["type"].alias("event_type"))


@query(
    "row_checksum_maps",
    f"""select user_id, sha256(concat_ws('||', user_id, '{{k -> ' || k || ', type -> ' || event_type || '}}')) as "Row_Checksum",
               count(*) * 2 as copies from ({MAPS_SQL}) group by all""",
)
def map_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = row_checksum(_with_maps(spark, sf_dir))
    return digests.groupBy("user_id", "Row_Checksum").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "unique_over_days",
    """select s.name as span, c.name as "column", count(distinct case c.name when 'user_id' then cast(user_id as varchar)
              when 'event_id' then cast(event_id as varchar) else kind end)
              + max(case when c.name = 'kind' and kind is null then 1 else 0 end) as exact, true as within
       from (select *, nullif(event_type, 'error') as kind, day(ts) as day from events),
            (values ('first', 1, 10), ('late', 11, 30), ('all', 1, 30)) s(name, lo, hi),
            (values ('user_id'), ('event_id'), ('kind')) c(name)
       where day between lo and hi group by all""",
)
def unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates from the sketches of three parts of a month against exact counts over the rows."""
    events = table(spark, sf_dir, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    day, path = F.dayofmonth("ts"), staging_path(spark, "sketches")
    columns = ["user_id", "event_id", "kind"]
    for last in (10, 20, 30):
        part = events.where((day > last - 10) & (day <= last))
        keep_sketches(part, path, f"2024-01-{last}", columns)
    found = []
    for name, lo, hi in (("first", 1, 10), ("late", 11, 30), ("all", 1, 30)):
        rows = events.where(day.between(lo, hi))
        exact = rows.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
        named = [F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("exact")) for c in columns]
        counts = exact.select(F.inline(F.array(*named)))
        near = unique_over(spark, path, f"2024-01-{lo:02}", f"2024-01-{hi}").join(counts, "column")
        within = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * F.col("error") + 1
        found.append(near.select(F.lit(name).alias("span"), "column", "exact", within.alias("within")))
    return found[0].unionByName(found[1]).unionByName(found[2])


BUCKETS = 8


@query(
    "merge_bucketed",
    """select o_custkey as custkey, o_orderkey, o_totalprice, c_name from
       (select * from orders qualify row_number() over (partition by o_custkey order by o_orderkey) = 1)
       join customer on o_custkey = c_custkey""",
)
def bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of every customer, by tables that are kept by the customer's key."""
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    for name, rows in zip(names, (orders, customers), strict=True):
        write_bucketed(rows, name, ["custkey"], BUCKETS)
    first = dedupe(spark.table(names[0]), ["custkey"], {"o_orderkey": "ASC"})
    return merge_sources(first, spark.table(names[1]), ["custkey"])


@query(
    "clustered_layout",
    """select * from orders where o_custkey between 10 and 60
       union all select * from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1996-02-01'""",
)
def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "clustered")
    write_clustered(table(spark, sf_dir, "orders"), path, ["o_custkey", "o_orderdate"], 16)
    layer = read_layer(spark, path)
    days = F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-02-01").cast("timestamp_ntz"))
    return layer.where(F.col("o_custkey").between(10, 60)).unionByName(layer.where(days))
