"""Filter trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.functions import blank_match, regex_match
from stratalift.operators import filter_tree
from stratalift.queries.registry import query, table

BLANKED_SQL = """case event_type when 'click' then '' when 'view' then '  '
    when 'error' then null else event_type end"""


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose type has NULL, empty and whitespace values, which the tables lack."""
    kind = F.col("event_type")
    gaps = (
        F.when(kind == "click", "")
        .when(kind == "view", "  ")
        .when(kind == "error", F.lit(None).cast("string"))
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").withColumn("event_type", gaps)


@query(
    "filter_tree",
    """select * from customer
       where (((c_mktsegment in ('BUILDING', 'MACHINERY') or c_nationkey = 3) and c_acctbal > 0)
              and c_custkey <> 7) and c_custkey <> 8""",
)
def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = {
        "OR": {"==": {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": [3]}},
        "AND": {">": {"c_acctbal": [""]}, "!=": {"c_custkey": [7, 8]}},
    }
    return filter_tree(table(spark, sf_dir, "customer"), tree)


@query(
    "filter_missing_column",
    "select * from customer where c_nationkey = 3",
)
def missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = {"AND": {"==": {"no_such_column": ["x"], "c_nationkey": [3]}}}
    return filter_tree(table(spark, sf_dir, "customer"), tree)


ODD_KEYS_SQL = """select o_orderkey, o_custkey, case o_custkey % 5
        when 0 then o_custkey || '.0000000001' when 1 then '1e30'
        when 2 then '-' || o_custkey || '.5' else cast(o_custkey as varchar) end as spelled
    from orders"""


def spelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is text: long fractions, exponents, negative and plain numbers."""
    key = F.col("o_custkey").cast("string")
    spelled = (
        F.when(F.col("o_custkey") % 5 == 0, F.concat(key, F.lit(".0000000001")))
        .when(F.col("o_custkey") % 5 == 1, F.lit("1e30"))
        .when(F.col("o_custkey") % 5 == 2, F.concat(F.lit("-"), key, F.lit(".5")))
        .otherwise(key)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.withColumn("spelled", spelled)


@query(
    "filter_number_in_text",
    f"""select o_orderkey, spelled from ({ODD_KEYS_SQL})
        where o_custkey % 5 = 1 or (o_custkey % 5 = 0 and o_custkey >= 50)
              or (o_custkey % 5 > 2 and o_custkey > 50)""",
)
def number_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_tree(spelled_orders(spark, sf_dir), {"AND": {">": {"spelled": [50]}}})
    return kept.select("o_orderkey", "spelled")


@query(
    "filter_number_in_text_range",
    f"""select o_orderkey, spelled from ({ODD_KEYS_SQL})
        where (o_custkey % 5 = 2 and o_custkey >= 40) is not true and o_custkey % 5 <> 1
              and case o_custkey % 5 when 2 then true else o_custkey <= 120 end""",
)
def number_in_text_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = {"AND": {">=": {"spelled": [-40]}, "<=": {"spelled": [120.5]}}}
    return filter_tree(spelled_orders(spark, sf_dir), tree).select("o_orderkey", "spelled")


@query(
    "filter_long_list",
    f"""select o_orderkey, spelled from ({ODD_KEYS_SQL})
        where o_custkey % 5 > 2 and o_custkey % 3 = 0 and o_custkey < 15000""",
)
def long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = {"OR": {"==": {"spelled": list(range(0, 15_000, 3))}}}
    return filter_tree(spelled_orders(spark, sf_dir), tree).select("o_orderkey", "spelled")


def _comparison(name: str, comparator: str, value: object, sql_condition: str) -> None:
    column = "event_type" if name in ("eq", "ne", "null", "notnull") else "value"

    @query(
        f"filter_ops_{name}",
        f"""select event_id, event_type, value
            from (select event_id, nullif(event_type, 'error') as event_type, value - 20 as value
                  from events)
            where {sql_condition}""",
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        gapped = table(spark, sf_dir, "events").select(
            "event_id",
            F.nullif("event_type", F.lit("error")).alias("event_type"),
            (F.col("value") - 20).alias("value"),
        )
        return filter_tree(gapped, {"AND": {comparator: {column: [value]}}})


_comparison("eq", "==", "click", "event_type = 'click'")
_comparison("ne", "!=", "click", "event_type <> 'click'")
_comparison("gt", ">", 10, "value > 10")
_comparison("ge", ">=", "10.5", "value >= 10.5")
_comparison("lt", "<", -7.69, "value < -7.69")
_comparison("le", "<=", "", "value <= 0")
_comparison("null", "==", "Null", "event_type is null")
_comparison("notnull", "!=", None, "event_type is not null")


@query(
    "filter_regex",
    "select doc_id, source from documents where regexp_matches(source, '^src[0-4]$')",
)
def regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return documents.where(regex_match(F.col("source"), "^src[0-4]$"))


@query(
    "filter_blank",
    f"""select event_id, event_type
        from (select event_id, {BLANKED_SQL} as event_type from events)
        where regexp_matches(event_type, '^\\s*$')""",
)
def blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    gapped = events_with_gaps(spark, sf_dir).select("event_id", "event_type")
    return gapped.where(blank_match(F.col("event_type")))
