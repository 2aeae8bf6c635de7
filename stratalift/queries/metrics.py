"""Counts, profiles and checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.operators import (
    cast_failures,
    dataset_checksum,
    dedupe,
    group_agg,
    quality_report,
    row_checksum,
    row_count,
    row_reconciliation,
)
from stratalift.plans.spec import EXPRESSIONS
from stratalift.queries.filters import BLANKED_SQL, events_with_gaps
from stratalift.queries.registry import query, table
from stratalift.staging import stage_rows

CHECKS = ("Null", "Blank", "Unique", "UserDefined:alphanumeric")


def profile_sql(rows: str, columns: tuple[str, ...], gross: str) -> str:
    """The long profile of the columns, as one SELECT per check."""
    counts = []
    for c in columns:
        unique = f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end)"
        text = f"cast({c} as varchar)"
        for check, count in (
            ("Null", f"count(*) filter ({c} is null)"),
            ("Blank", f"count(*) filter (regexp_matches({text}, '^\\s*$'))"),
            ("Unique", unique),
            ("Duplicate", f"({gross}) - ({unique})"),
            (
                "UserDefined:alphanumeric",
                f"count(*) filter (regexp_matches({text}, '^[a-zA-Z0-9]+$'))",
            ),
        ):
            counts.append(
                f"""select '{c}' as "column", '{check}' as "check",
                           cast({count} as bigint) as cnt from t"""
            )
    return f"""with t as ({rows})
        select "column", "check", cnt, cnt / ({gross}) * 100 as pct_of_gross
        from ({' union all '.join(counts)})"""


@query("row_count", "select count(*) as rows from lineitem")
def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "quality_report",
    profile_sql(
        f"select event_id, {BLANKED_SQL} as event_type from events",
        ("event_id", "event_type"),
        "select count(*) from t",
    ),
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"event_id": CHECKS, "event_type": CHECKS, "not_there": CHECKS}
    return quality_report(events_with_gaps(spark, sf_dir), checks, EXPRESSIONS)


@query(
    "quality_report_deduped",
    profile_sql(
        "select * from documents qualify row_number() over (partition by text order by doc_id) = 1",
        ("text", "lang", "source"),
        "select count(*) from documents",
    ),
)
def profile_of_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    # staged, as counts and distinct counts each read it
    unique = stage_rows(dedupe(documents, ["text"], {"doc_id": "ASC"}), "unique")
    checks = {c: CHECKS for c in ("text", "lang", "source")}
    return quality_report(unique, checks, EXPRESSIONS, gross=row_count(documents))


@query(
    "cast_failures",
    """select 'o_orderpriority' as "column",
              count(*) filter (try_cast(o_orderpriority as integer) is null) as failed from orders
       union all
       select 'o_custkey', count(*) filter (try_cast(o_custkey as tinyint) is null) from orders""",
)
def failed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_failures(
        table(spark, sf_dir, "orders"), {"o_orderpriority": "integer", "o_custkey": "byte"}
    )


@query(
    "row_reconciliation",
    """with u as (select * from documents
                  qualify row_number() over (partition by text order by doc_id) = 1),
            c as (select (select count(*) from documents) as gross,
                         (select count(*) from u) as uniq,
                         (select count(*) from u where lang = 'en' or lang = 'fr') as net)
       select gross, gross - uniq as duplicates, uniq - net as filtered, net from c""",
)
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_reconciliation(
        table(spark, sf_dir, "documents"),
        ["text"],
        {"doc_id": "ASC"},
        {"OR": {"==": {"lang": ["en", "fr"]}}},
    )


@query(
    "group_agg",
    """select l_returnflag, l_linestatus,
              round(sum(l_extendedprice), 2) as revenue, round(avg(l_discount), 6) as discount,
              min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, count(l_orderkey) as lines
       from lineitem group by l_returnflag, l_linestatus""",
)
def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = group_agg(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "l_extendedprice:revenue": "SUM",
            "l_discount:discount": "AVG",
            "l_shipdate:first_ship": "MIN",
            # one field may be aggregated under several aliases
            "l_shipdate:last_ship": "MAX",
            "l_orderkey:lines": "COUNT",
        },
    )
    return groups.withColumns(
        {"revenue": F.round("revenue", 2), "discount": F.round("discount", 6)}
    )


EVENT_TEXT = "concat_ws('||', event_id, ts, user_id, event_type, value, props)"


@query("row_checksum", f'select *, sha256({EVENT_TEXT}) as "Row_Checksum" from events')
def row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_checksum(table(spark, sf_dir, "events"))


@query(
    "row_checksum_strict",
    """select event_id, event_type, sha256(
           coalesce(length(cast(event_id as varchar)) || ':' || event_id, '~') || '||' ||
           coalesce(length(event_type) || ':' || event_type, '~')) as "Row_Checksum"
       from (select event_id, nullif(event_type, 'error') as event_type from events)""",
)
def strict_row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    gapped = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return row_checksum(gapped, strict=True)


def additive_sql(digests: str) -> str:
    """The additive form over row digests ``h``: 15 digits of each quarter, in parts of 15 bits."""
    sums = ", ".join(
        f"sum(cast('0x' || substr(h, {1 + 16 * quarter}, 15) as bigint) >> {shift} & 32767)"
        for quarter in range(4)
        for shift in range(0, 60, 15)
    )
    return f"""select case when count(h) > 0 then sha256(concat_ws(',', count(h), {sums})) end
                   as checksum, 'additive' as mode from ({digests})"""


EVENT_DIGESTS = f"select sha256({EVENT_TEXT}) as h from events"


@query("dataset_checksum_additive", additive_sql(EVENT_DIGESTS))
def additive_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_checksum(table(spark, sf_dir, "events"), "additive")


def tree_sql(digests: str) -> str:
    """The tree over row digests ``h``: 16^6 leaves, folded by two digits up to the root."""
    return f"""with h0 as ({digests}),
        h1 as (select h, count(*) as n from h0 group by h),
        l6 as (select substr(h, 1, 6) as p, h || ':' || n as d from h1),
        l4 as (select substr(p, 1, 4) as q, p || ':' || sha256(string_agg(d, ',' order by d)) as d
               from l6 group by p),
        l2 as (select substr(q, 1, 2) as r, q || ':' || sha256(string_agg(d, ',' order by d)) as d
               from l4 group by q),
        l0 as (select r || ':' || sha256(string_agg(d, ',' order by d)) as d from l2 group by r)
        select sha256(string_agg(d, ',' order by d)) as checksum, 'tree' as mode from l0"""


@query("dataset_checksum", tree_sql(EVENT_DIGESTS))
def checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_checksum(table(spark, sf_dir, "events"), "tree")


@query(
    "dataset_checksum_tree",
    tree_sql("select sha256(concat_ws('||', user_id, event_type)) as h from events"),
)
def tree_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = table(spark, sf_dir, "events").select("user_id", "event_type")
    return dataset_checksum(copies, "tree")
