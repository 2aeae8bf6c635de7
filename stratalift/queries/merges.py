"""Merging sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.operators import merge_rows, merge_sources
from stratalift.queries.registry import query, table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of some segments, so that left and anti joins have unmatched rows."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
        .select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey")
    )


CUSTOMERS_SQL = """(select c_custkey as custkey, c_name, c_nationkey from customer
                    where c_mktsegment in ('BUILDING', 'MACHINERY')) c"""
ORDERS_SQL = """(select o_orderkey, o_custkey as custkey, o_orderstatus, o_totalprice,
                        o_orderdate, o_orderpriority from orders) o"""


def _joined(name: str, how: str, sql: str, salts: int | None = None) -> None:
    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merge_sources(
            _orders(spark, sf_dir), _customers(spark, sf_dir), ["custkey"], how, salts
        )


_joined("merge_join", "inner", f"select * from {ORDERS_SQL} join {CUSTOMERS_SQL} using (custkey)")
_joined(
    "merge_left", "left", f"select * from {ORDERS_SQL} left join {CUSTOMERS_SQL} using (custkey)"
)
_joined(
    "merge_semi", "semi", f"select * from {ORDERS_SQL} semi join {CUSTOMERS_SQL} using (custkey)"
)
_joined(
    "merge_anti", "anti", f"select * from {ORDERS_SQL} anti join {CUSTOMERS_SQL} using (custkey)"
)


@query(
    "merge_salted",
    """select d.doc_id, d.lang, d.source, s.n_docs
       from documents d left join
            (select source, count(*) as n_docs from documents where lang <> 'en' group by source) s
            using (source)""",
)
def salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    counts = (
        documents.where("lang <> 'en'").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    )
    left = documents.select("doc_id", "lang", "source")
    return merge_sources(left, counts, ["source"], "left", salts=16)


@query(
    "merge_union",
    """select c_custkey as key, c_name as name, c_nationkey as nationkey, c_mktsegment as segment
       from customer
       union all
       select s_suppkey, s_name, s_nationkey, null from supplier""",
)
def unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("key"),
    )
    return merge_rows(customers, suppliers)
