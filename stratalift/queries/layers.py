"""Layers written and read back, transfers between them, and their comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.plans import (
    ColumnSpec,
    FileLayer,
    LineageError,
    MergeStep,
    RunOptions,
    TableSpec,
    TransferResult,
    display_layers,
    layer_checksum_diff,
    layer_row_counts,
    run_lineage,
    transfer,
    transform,
)
from stratalift.operators import sort_multi
from stratalift.queries.metrics import CHECKS, additive_sql, profile_sql, tree_sql
from stratalift.queries.registry import query, table
from stratalift.sinks import (
    append_audit,
    dated_snapshot,
    register_catalog,
    write_catalog,
    write_layer,
)
from stratalift.sources import read_dated, read_layer, string_landing
from stratalift.staging import staging_path

RUN_DATE = "2025-03-01"
DIMENSIONS = ("day", "o_orderpriority", "o_orderstatus")
METRICS = ("o_orderkey", "o_custkey", "o_totalprice")

ORDER_SPEC = TableSpec(
    family="sales",
    table="orders",
    dimensions=(
        ColumnSpec("day", "date", rename="Date"),
        ColumnSpec("o_orderpriority", rename="RK-Priority", quality=CHECKS),
        ColumnSpec("o_orderstatus", rename="Status", quality=CHECKS),
    ),
    metrics=(
        ColumnSpec("o_orderkey", "long", rename="Order"),
        ColumnSpec("o_custkey", "long", drop=True),
        ColumnSpec("o_totalprice", "double", rename="Price", quality=("Null", "Unique")),
    ),
    filter={
        "OR": {"==": {"o_orderstatus": ["F", "P"]}},
        "AND": {">": {"o_totalprice": [50000]}, "!=": {"o_orderpriority": ["5-LOW"]}},
    },
    compact_dates=("day",),
    replace={"o_orderstatus": {"P": "Pending"}},
    divide={"Price_Per_Customer": {"o_totalprice": "o_custkey"}},
    split={
        "Priority-Code": {"-": {"o_orderpriority": 0}},
        "Priority-Name": {"-": {"o_orderpriority": 1}},
    },
    sort={"day": "ASC", "o_totalprice": "DESC"},
)

SILVER_SQL = """select cast(o_orderdate as date) as "Date", o_orderpriority as "RK-Priority",
                       replace(o_orderstatus, 'P', 'Pending') as "Status", o_orderkey as "Order",
                       o_totalprice as "Price",
                       cast(o_totalprice / nullif(o_custkey, 0) as float) as "Price_Per_Customer",
                       string_split(o_orderpriority, '-')[1] as "Priority-Code",
                       string_split(o_orderpriority, '-')[2] as "Priority-Name"
                from orders
                where o_orderstatus in ('F', 'P') and o_totalprice > 50000
                  and o_orderpriority <> '5-LOW'"""

# The landed rows: all text, the price as it is spelled with two decimals.
LANDED_SQL = """select strftime(o_orderdate, '%Y%m%d') as day, o_orderpriority, o_orderstatus,
                       cast(o_orderkey as varchar) as o_orderkey,
                       cast(o_custkey as varchar) as o_custkey,
                       cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice
                from orders"""


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = (
        table(spark, sf_dir, "orders")
        .withColumn("day", F.date_format("o_orderdate", "yyyyMMdd"))
        .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    )
    return string_landing(orders, DIMENSIONS, METRICS)


@query("transfer_bl_sl", SILVER_SQL)
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(landed_orders(spark, sf_dir), ORDER_SPEC)


def _layers(root: str) -> dict[str, FileLayer]:
    return {
        "LZ": FileLayer(f"{root}/LZ"),
        "RZ": FileLayer(f"{root}/RZ", dated=True),
        "BL": FileLayer(f"{root}/BL"),
        "SL": FileLayer(f"{root}/SL"),
        "GL": FileLayer(f"{root}/GL"),
    }


def _options(**more) -> RunOptions:
    return RunOptions(RUN_DATE, run_ts="2025-03-01 10:20:30", runner="tester", **more)


def _hop(spark: SparkSession, sf_dir: str) -> TransferResult:
    layers = _layers(staging_path(spark, "hop"))
    write_layer(landed_orders(spark, sf_dir), layers["BL"].path)
    return transfer(spark, ORDER_SPEC, "BL", None, layers, _options(integrity=True))


ROW_TEXT = """concat_ws('||', day, o_orderpriority, o_orderstatus, o_orderkey, o_custkey,
                        o_totalprice)"""


@query(
    "transfer_table",
    f"""select s.*, l."Row_Checksum",
               timestamp '2025-03-01 10:20:30' as "Row_Inserted-On",
               'Bronze Layer - Direct - tester' as "Row_Inserted-By",
               timestamp '2025-03-01 10:20:30' as "Row_Updated-On",
               'Bronze Layer - Direct - tester' as "Row_Updated-By"
        from ({SILVER_SQL}) s join
             (select o_orderkey, sha256({ROW_TEXT}) as "Row_Checksum" from ({LANDED_SQL})) l
             on s."Order" = cast(l.o_orderkey as bigint)""",
)
def transfer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _hop(spark, sf_dir).table
    stamps = ("Row_Inserted-On", "Row_Updated-On")
    return written.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in stamps})


@query(
    "transfer_report",
    f"""select 'sales' as family, 'orders' as table_name, 'BL' as source, 'SL' as target,
               'Bronze Layer - Direct - tester' as run_by, 200 as status,
               'Price_Per_Customer,Priority-Code,Priority-Name' as columns_added,
               'o_custkey' as columns_purged, 'day,o_orderstatus' as columns_updated,
               (select count(*) from orders) as rows_gross,
               (select count(*) from ({SILVER_SQL})) as rows_net, 0 as rows_duplicates,
               (select count(*) from orders) - (select count(*) from ({SILVER_SQL}))
                   as rows_filtered,
               (select count(*) from ({SILVER_SQL})) as rows_written,
               'additive' as checksum_mode, 'SHA-256' as hash""",
)
def transfer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _hop(spark, sf_dir).report
    lists = ("columns_added", "columns_purged", "columns_updated")
    return report.select(
        *("family", "table_name", "source", "target", "run_by", "status"),
        *[F.concat_ws(",", c).alias(c) for c in lists],
        *("rows_gross", "rows_net", "rows_duplicates", "rows_filtered", "rows_written"),
        *("checksum_mode", "hash"),
    )


@query(
    "transfer_quality",
    f"""select * from ({profile_sql(LANDED_SQL, ("o_orderpriority", "o_orderstatus"),
                                    "select count(*) from t")})
        union all
        select * from ({profile_sql(LANDED_SQL, ("o_totalprice",), "select count(*) from t")})
        where "check" in ('Null', 'Unique', 'Duplicate')""",
)
def transfer_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hop(spark, sf_dir).quality


GOLD_SPEC = TableSpec(
    family="sales",
    table="orders",
    dimensions=(
        ColumnSpec("day", "date", rename="Date"),
        ColumnSpec("o_orderpriority", rename="Priority", quality=CHECKS),
        ColumnSpec("o_orderstatus"),
    ),
    metrics=(
        ColumnSpec("o_orderkey", "long"),
        ColumnSpec("o_custkey", "long", rename="Customer"),
        ColumnSpec("o_totalprice", "double", rename="Price"),
    ),
    filter={"AND": {"==": {"o_orderstatus": ["F"]}}},
    compact_dates=("day",),
    sort={"day": "ASC"},
    dedupe=True,
    group_by=("Segment", "Priority"),
    group_aggs={"Price:Revenue": "SUM", "Price:Top": "MAX", "o_orderkey:Orders": "COUNT"},
)


def _lineage(spark: SparkSession, sf_dir: str) -> tuple[dict[str, FileLayer], DataFrame]:
    layers = _layers(staging_path(spark, "lineage"))
    landed = landed_orders(spark, sf_dir)
    # the landing zone got every open order twice
    write_layer(landed.unionByName(landed.where("o_orderstatus = 'O'")), layers["LZ"].path)
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer"), F.col("c_mktsegment").alias("Segment")
    )
    options = _options(integrity=True, merges=(MergeStep(customers, ("Customer",)),))
    reports = run_lineage(spark, [GOLD_SPEC], {"orders": layers}, options)
    return layers, reports


@query(
    "lineage_gold",
    """select c_mktsegment as "Segment", o_orderpriority as "Priority",
              round(sum(o_totalprice), 2) as "Revenue", max(o_totalprice) as "Top",
              count(*) as "Orders"
       from orders join customer on o_custkey = c_custkey
       where o_orderstatus = 'F' group by c_mktsegment, o_orderpriority""",
)
def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers, _ = _lineage(spark, sf_dir)
    return layers["GL"].read(spark).select(
        "Segment",
        "Priority",
        F.round("Revenue", 2).alias("Revenue"),
        "Top",
        "Orders",
    )


@query(
    "lineage_reports",
    """with n as (select count(*) as n, count(*) filter (o_orderstatus = 'O') as o,
                         count(*) filter (o_orderstatus = 'F') as f from orders)
       select 'LZ' as source, 'RZ' as target, 200 as status, n + o as rows_gross, n as rows_net,
              o as rows_duplicates, 0 as rows_filtered from n
       union all select 'RZ', 'BL', 200, n, n, 0, 0 from n
       union all select 'BL', 'SL', 200, n, f, 0, n - f from n
       union all select 'SL', 'GL', 200, f, f, 0, 0 from n""",
)
def lineage_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports = _lineage(spark, sf_dir)
    return reports.select(
        *("source", "target", "status", "rows_gross", "rows_net"),
        *("rows_duplicates", "rows_filtered"),
    )


@query("layer_roundtrip", "select * from supplier")
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "layer")
    write_layer(table(spark, sf_dir, "supplier"), path)
    return read_layer(spark, path)


@query("catalog_roundtrip", "select * from supplier")
def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"supplier_{uuid.uuid4().hex}"
    suppliers = table(spark, sf_dir, "supplier")
    write_catalog(suppliers, name, path=staging_path(spark, "catalog"))
    return spark.table(name)


@query("dated_snapshot", "select * from orders where o_orderstatus = 'F'")
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dated(spark, _two_days(spark, sf_dir), "2025-03-01")


@query("dated_snapshot_latest", "select * from orders where o_orderstatus <> 'F'")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dated(spark, _two_days(spark, sf_dir))


@query(
    "dated_snapshot_schema",
    """select c_custkey, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment
       from customer where c_custkey % 2 = 0""",
)
def snapshot_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day has one more column than the first, and one of another type."""
    path = staging_path(spark, "dated")
    customers = table(spark, sf_dir, "customer")
    dated_snapshot(customers.select("c_custkey", "c_nationkey"), path, "2025-03-01")
    second = customers.where("c_custkey % 2 = 0").select(
        "c_custkey", F.col("c_nationkey").cast("string"), "c_mktsegment"
    )
    dated_snapshot(second, path, "2025-03-02")
    return read_dated(spark, path, "2025-03-02")


def _two_days(spark: SparkSession, sf_dir: str) -> str:
    path = staging_path(spark, "dated")
    orders = table(spark, sf_dir, "orders")
    dated_snapshot(orders, path, "2025-03-01")
    dated_snapshot(orders.where("o_orderstatus <> 'F'"), path, "2025-03-02")
    # a day written again is replaced
    dated_snapshot(orders.where("o_orderstatus = 'F'"), path, "2025-03-01")
    return path


@query(
    "audit_sink",
    """select 'orders' as table_name, 'BL' as source, 'SL' as target, 200 as status,
              (select count(*) from orders) as rows_gross
       union all select 'orders', 'BL', 'SL', 200, (select count(*) from orders)""",
)
def audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"pipeline_runs_{uuid.uuid4().hex}"
    report = _hop(spark, sf_dir).report
    append_audit(report, name, staging_path(spark, "audit"))
    append_audit(report, name)
    return spark.table(name).select("table_name", "source", "target", "status", "rows_gross")


def _compared(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """Two tables over three layers, one of which loses rows on the way."""
    layers = _layers(staging_path(spark, "compare"))
    landed = landed_orders(spark, sf_dir)
    write_layer(landed, layers["LZ"].path)
    dated_snapshot(landed.repartition(3), layers["RZ"].path, RUN_DATE)
    write_layer(landed.where("o_orderstatus <> 'P'"), layers["BL"].path)
    read = {name: layers[name].read(spark, RUN_DATE) for name in ("LZ", "RZ", "BL")}
    keys = {name: df.select("o_orderkey", "day") for name, df in read.items()}
    return {"orders": read, "order_keys": keys}


@query(
    "layer_row_counts",
    """select t.table_name, l.layer, case when l.layer = 'BL' then k.kept else k.n end as rows
       from (values ('orders'), ('order_keys')) t(table_name),
            (values ('LZ'), ('RZ'), ('BL')) l(layer),
            (select count(*) as n, count(*) filter (o_orderstatus <> 'P') as kept from orders) k""",
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_row_counts(spark, _compared(spark, sf_dir)).drop("failure")


def _diff_sql(digest_of: Callable[[str], str]) -> str:
    kept = f"{LANDED_SQL} where o_orderstatus <> 'P'"
    texts = {"orders": ROW_TEXT, "order_keys": "concat_ws('||', o_orderkey, day)"}
    rows = []
    for name, text in texts.items():
        for layer, source, verdict in (
            ("LZ", LANDED_SQL, "Baseline"),
            ("RZ", LANDED_SQL, "same"),
            ("BL", kept, "not equal"),
        ):
            digest = digest_of(f"select sha256({text}) as h from ({source})")
            rows.append(
                f"""select '{name}' as table_name, '{layer}' as layer, checksum,
                           '{verdict}' as verdict from ({digest})"""
            )
    return " union all ".join(rows)


@query("layer_checksum_diff_tree", _diff_sql(tree_sql))
def tree_checksum_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_checksum_diff(spark, _compared(spark, sf_dir), "tree").drop("failure")


@query("layer_checksum_diff", _diff_sql(additive_sql))
def checksum_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_checksum_diff(spark, _compared(spark, sf_dir)).drop("failure")


@query(
    "layer_checksum_diff_strict",
    """select 'orders' as table_name, layer, verdict from
       (values ('LZ', 'Baseline'), ('RZ', case when (select count(*) from orders) > 0
                                          then 'not equal' else 'same' end)) l(layer, verdict)""",
)
def strict_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values with a NULL before or behind them."""
    orders = table(spark, sf_dir, "orders")
    key, gap = F.col("o_orderkey").cast("string"), F.lit(None).cast("string")
    layers = {
        "LZ": orders.select(gap.alias("a"), key.alias("b")),
        "RZ": orders.select(key.alias("a"), gap.alias("b")),
    }
    diff = layer_checksum_diff(spark, {"orders": layers}, strict=True)
    return diff.select("table_name", "layer", "verdict")


@query(
    "layer_row_counts_failure",
    """select 'orders' as table_name, 'LZ' as layer, count(*) as rows, false as failed from orders
       union all select 'orders', 'RZ', null, true
       union all select 'orders', 'BL', count(*), false from orders where o_orderstatus = 'F'""",
)
def counts_with_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    nowhere = staging_path(spark, "nowhere")
    layers = {
        "LZ": orders,
        "RZ": lambda: read_layer(spark, nowhere),
        "BL": orders.where("o_orderstatus = 'F'"),
    }
    counted = layer_row_counts(spark, {"orders": layers})
    return counted.select("table_name", "layer", "rows", F.col("failure").isNotNull().alias("failed"))


@query(
    "lineage_failure",
    """select 'LZ' as source, 'RZ' as target, 200 as status, (select count(*) from orders) as rows_gross
       union all select 'RZ', 'BL', 200, (select count(*) from orders)
       union all select 'BL', 'SL', 404, (select count(*) from orders)""",
)
def lineage_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sort by a column that does not exist fails at the transform, behind two good hops."""
    layers = _layers(staging_path(spark, "lineage"))
    write_layer(landed_orders(spark, sf_dir), layers["LZ"].path)
    spec = replace(ORDER_SPEC, sort={"no_such_column": "ASC"})
    try:
        reports = run_lineage(spark, [spec], {"orders": layers}, _options())
    except LineageError as error:
        reports = error.reports
    return reports.select("source", "target", "status", "rows_gross")


@query("catalog_dated", "select * from orders where o_orderstatus <> 'F'")
def catalog_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table points at the day that was written last."""
    layer = FileLayer(_two_days(spark, sf_dir), dated=True)
    name = f"orders_{uuid.uuid4().hex}"
    for day in ("2025-03-01", "2025-03-02"):
        register_catalog(spark, name, layer.place(day))
    return spark.table(name)


@query(
    "display_layers",
    """select layer, o_orderkey from (select 'LZ' as layer, o_orderkey from orders
                                      order by o_orderkey limit 5)
       union all select layer, o_orderkey from (select 'BL' as layer, o_orderkey from orders
                 where o_orderstatus <> 'P' order by o_orderkey limit 5)""",
)
def displayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    layers = {"LZ": orders, "BL": orders.where("o_orderstatus <> 'P'")}
    sorted_layers = {name: sort_multi(df, {"o_orderkey": "ASC"}) for name, df in layers.items()}
    shown = display_layers({"orders": sorted_layers}, 5)
    rows = [df.select(F.lit(layer).alias("layer"), "o_orderkey") for (_, layer), df in shown.items()]
    return rows[0].unionByName(rows[1])


@query(
    "lineage_resumed",
    """select 'LZ' as source, 'RZ' as target, (select count(*) from orders) as rows_gross, 2 as runs
       union all select 'RZ', 'BL', (select count(*) from orders), 2
       union all select 'BL', 'SL', (select count(*) from orders), 1""",
)
def lineage_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails at its third hop is taken up again; ``runs`` says in how many reports a
    hop's very result is found."""
    layers = _layers(staging_path(spark, "lineage"))
    write_layer(landed_orders(spark, sf_dir), layers["LZ"].path)
    options = _options(audit_table=f"runs_{uuid.uuid4().hex}", run_id="run 7")
    hops = {"LZ": "RZ", "RZ": "BL", "BL": "SL"}
    try:
        run_lineage(spark, [replace(ORDER_SPEC, sort={"no_such_column": "ASC"})], {"orders": layers}, options, hops)
    except LineageError as error:
        first = error.reports
    second = run_lineage(spark, [ORDER_SPEC], {"orders": layers}, options, hops, workers=2)
    both = first.where("status = 200").unionByName(second)
    runs = both.groupBy("source", "target", "rows_gross", "started", "ended").agg(F.count(F.lit(1)).alias("runs"))
    return runs.select("source", "target", "rows_gross", F.col("runs").cast("int").alias("runs"))
