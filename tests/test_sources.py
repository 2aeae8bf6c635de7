from datetime import date

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from stratalift.sources import (
    date_window,
    dimension_in_list,
    incremental_window,
    non_empty,
    paged_source,
    read_pages,
    report_query,
    string_landing,
)

TOTAL = 1050


@pytest.fixture(scope="module")
def days(spark):
    rows = [(i, date(2025, 1, 1 + i)) for i in range(10)]
    return spark.createDataFrame(rows, "id int, day date")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_date_window_is_inclusive_for_every_time_type(days):
    assert ids(date_window(days, "day", "2025-01-02", "2025-01-04")) == [1, 2, 3]
    for kind in ("timestamp", "timestamp_ntz"):
        noon = days.select("id", (F.col("day").cast(kind) + F.expr("interval 12 hours")).alias("day"))
        assert ids(date_window(noon, "day", date(2025, 1, 2), date(2025, 1, 4))) == [1, 2, 3]
    assert ids(date_window(days, "day", "2025-01-09")) == [8, 9]


def test_date_window_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(date_window(events, "ts", "2024-01-02", "2024-01-03"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_incremental_window(days):
    landed = days.where("id <= 4")
    assert ids(incremental_window(days, landed, "day", hi="2025-01-08")) == [5, 6, 7]
    # up to date already: nothing to do
    assert ids(incremental_window(days, landed, "day", hi="2025-01-05")) == []
    nothing = days.where("false")
    assert ids(incremental_window(days, nothing, "day", hi="2025-01-03")) == [0, 1, 2]
    assert ids(incremental_window(days, nothing, "day", hi="2025-01-03", start="2025-01-02")) == [1, 2]
    assert ids(incremental_window(days, nothing, "day")) == list(range(10))


@pytest.mark.parametrize("text_format", ["yyyyMMdd", "yyyy-MM-dd"])
def test_windows_over_text_dates(spark, days, either_ansi, text_format):
    landed = days.select("id", F.date_format("day", text_format).alias("day"))
    found = date_window(landed, "day", "2025-01-02", "2025-01-04", text_format)
    assert ids(found) == [1, 2, 3]
    part = landed.where("id <= 4")
    assert ids(incremental_window(landed, part, "day", "2025-01-08", text_format=text_format)) == [5, 6, 7]
    assert ids(incremental_window(landed, landed.where("false"), "day", "2025-01-02", text_format=text_format)) == [0, 1]


def test_text_dates_need_a_format(days):
    landed = days.select("id", F.date_format("day", "yyyyMMdd").alias("day"))
    with pytest.raises(ValueError, match="declare the format"):
        date_window(landed, "day", "2025-01-02")
    with pytest.raises(ValueError, match="not in the order"):
        date_window(landed, "day", "2025-01-02", text_format="dd.MM.yyyy")


def test_text_window_reaches_the_scan(spark, tmp_path, days):
    days.select("id", F.date_format("day", "yyyyMMdd").alias("day")).write.parquet(str(tmp_path / "t"))
    landed = spark.read.parquet(str(tmp_path / "t"))
    text = plan(date_window(landed, "day", "2025-01-02", "2025-01-04", "yyyyMMdd"))
    assert "GreaterThanOrEqual(day,20250102)" in text and "LessThan(day,20250105)" in text


def test_in_lists_and_together(days):
    found = dimension_in_list(days, {"id": [1, 2, "3"], "day": ["2025-01-03", "2025-01-04"]})
    assert ids(found) == [2, 3]


def test_string_landing_puts_dimensions_first(days):
    landed = string_landing(days, ["day"], ["id"])
    assert landed.dtypes == [("day", "string"), ("id", "string")]
    assert landed.orderBy("day").first()["day"] == "2025-01-01"


def test_non_empty(days):
    assert non_empty(days) is days
    with pytest.raises(ValueError, match="no rows"):
        non_empty(days.where("false"))


def test_report_pages_cover_the_report(days):
    def page(limit, offset):
        return report_query(
            days, ["id"], {"n": F.count("day")}, "day", "2025-01-02", "2025-01-09", None, limit, offset
        )

    whole = values(page(None, 0))
    assert len(whole) == 8
    assert [row for at in range(0, 8, 3) for row in values(page(3, at))] == whole


def counted_source(name, fail_at=None, total=TOTAL):
    def wanted(request):
        keep = request.in_lists.get("kind")
        return [i for i in range(total) if keep is None or f"k{i % 3}" in keep]

    def count_rows(request):
        return len(wanted(request))

    def fetch_page(request):
        if fail_at is not None and request.offset == fail_at:
            raise RuntimeError("page is broken")
        for i in wanted(request)[request.offset : request.offset + request.limit]:
            yield (f"k{i % 3}", i)

    return paged_source(name, ["kind", "n"], count_rows, fetch_page)


def test_pages_are_partitions(spark):
    pages = read_pages(spark, counted_source("numbers"), limit=100, pause=0)
    assert pages.dtypes == [("kind", "string"), ("n", "string")]
    assert pages.rdd.getNumPartitions() == 11
    assert sorted(int(r["n"]) for r in pages.collect()) == list(range(TOTAL))


def test_short_pages_fail(spark):
    def fetch_page(request):
        return [("a", i) for i in range(request.offset, request.offset + 90)]

    short = paged_source("short_pages", ["kind", "n"], lambda request: 1000, fetch_page)
    with pytest.raises(Exception, match="90 rows instead of 100"):
        read_pages(spark, short, limit=100, pause=0).collect()


def test_pages_at_once_are_bounded(spark):
    pages = read_pages(spark, counted_source("bounded"), limit=100, pause=0, concurrent=3)
    assert pages.rdd.getNumPartitions() == 3
    assert sorted(int(r["n"]) for r in pages.collect()) == list(range(TOTAL))


def test_pages_from_an_offset(spark):
    pages = read_pages(spark, counted_source("numbers_later"), limit=100, offset=990, pause=0)
    assert sorted(int(r["n"]) for r in pages.collect()) == list(range(990, TOTAL))


def test_pages_with_lists(spark):
    lists = {"kind": ["k1"]}
    pages = read_pages(spark, counted_source("numbers_listed"), limit=100, pause=0, in_lists=lists)
    assert pages.rdd.getNumPartitions() == 4
    assert sorted(int(r["n"]) for r in pages.collect()) == list(range(1, TOTAL, 3))


def test_pages_take_filters(spark):
    spark.dataSource.register(counted_source("numbers_pushed"))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pages = (
            spark.read.format("numbers_pushed")
            .options(limit=100, pause=0, pushdown="true")
            .load()
            .where("kind in ('k1', 'k2') and kind = 'k2' and n > '5'")
        )
        found = sorted(int(r["n"]) for r in pages.collect())
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert found == [i for i in range(2, TOTAL, 3) if str(i) > "5"]


def test_an_empty_source_raises_unless_allowed(spark):
    source = counted_source("numbers_none", total=0)
    with pytest.raises(Exception, match="no rows found"):
        read_pages(spark, source, pause=0).collect()
    assert read_pages(spark, source, pause=0, require_rows=False).collect() == []


def test_a_broken_page_fails_the_job(spark):
    source = counted_source("numbers_broken", fail_at=200)
    with pytest.raises(Exception, match="page is broken"):
        read_pages(spark, source, limit=100, pause=0).collect()


def test_pages_of_arrow_batches(spark):
    def fetch_page(request):
        import pyarrow as pa

        rows = range(request.offset, min(request.offset + request.limit, 30))
        yield pa.record_batch({"n": pa.array([str(i) for i in rows], pa.string())})

    source = paged_source("numbers_arrow", ["n"], lambda request: 30, fetch_page)
    pages = read_pages(spark, source, limit=8, pause=0)
    assert sorted(int(r["n"]) for r in pages.collect()) == list(range(30))
