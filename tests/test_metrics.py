import hashlib
import random

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from stratalift.operators import (
    cast_failures,
    dataset_checksum,
    group_agg,
    quality_report,
    row_checksum,
    row_count,
    row_reconciliation,
)

CHECKS = ("Null", "Blank", "Unique", "UserDefined:word")
REGEXES = {"word": "^[a-z]+$"}


def test_quality_report(spark, either_ansi):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("", None), ("  ", 2), (None, 2)], "s string, n int"
    )
    report = quality_report(df, {"n": ("Null", "Blank", "Unique"), "s": CHECKS, "zz": CHECKS}, REGEXES)
    assert [tuple(r) for r in report.collect()] == [
        ("n", "Null", 1, 20.0),
        ("n", "Blank", 0, 0.0),
        ("n", "Unique", 3, 60.0),
        ("n", "Duplicate", 2, 40.0),
        ("s", "Null", 1, 20.0),
        ("s", "Blank", 2, 40.0),
        ("s", "Unique", 4, 80.0),
        ("s", "Duplicate", 1, 20.0),
        ("s", "UserDefined:word", 2, 40.0),
    ]


def test_quality_report_shuffles_distinct_values_only(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    checks = {"event_type": CHECKS, "user_id": ("Unique",), "value": ("Null",)}
    text = plan(quality_report(events, checks, REGEXES))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # the subquery is printed with its parent and once by itself
    assert len({line.strip(" :+-") for line in shuffles}) == 1
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_quality_report_percentages_of_gross(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    gross = spark.range(8).agg(F.count(F.lit(1)))
    report = quality_report(df, {"s": ("Unique",)}, gross=gross)
    assert [tuple(r) for r in report.collect()] == [
        ("s", "Unique", 2, 25.0),
        ("s", "Duplicate", 6, 75.0),
    ]


def test_quality_report_of_nothing(spark, either_ansi):
    df = spark.createDataFrame([], "s string")
    assert values(quality_report(df, {"s": ("Null",)})) == [("s", "Null", 0, None)]
    assert values(quality_report(df, {"zz": ("Null",)})) == []


def test_quality_report_approx(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("s"))
    unique = quality_report(df, {"s": ("Unique",)}, approx=True).first()["cnt"]
    assert 45 <= unique <= 55


def test_unknown_checks_raise(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="no known expression"):
        quality_report(df, {"id": ("UserDefined:nope",)}, REGEXES)
    with pytest.raises(ValueError, match="unknown quality check"):
        quality_report(df, {"id": ("Fancy",)})


def test_cast_failures(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert values(cast_failures(df, {"a": "integer", "zz": "date"})) == [("a", 1)]


def test_row_count_and_reconciliation(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "k int, v int")
    assert row_count(df).first()["rows"] == 4
    tree = {"AND": {"!=": {"k": [3]}}}
    assert values(row_reconciliation(df, ["k"], {"v": "ASC"}, tree)) == [(4, 1, 1, 2)]
    assert values(row_reconciliation(df)) == [(4, 0, 0, 4)]


def test_group_agg(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "g string, v int")
    groups = group_agg(df, ["g"], {"v:total": "sum", "v:mean": "AVG", "v": "MAX"})
    assert values(groups) == [("a", 3, 1.5, 2), ("b", 5, 5.0, 5)]
    with pytest.raises(ValueError, match="unknown aggregate"):
        group_agg(df, ["g"], {"v": "MEDIAN"})


ROWS = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "c"), (30, "é", "c")]
SCHEMA = "n int, s string, t string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_texts(rows):
    return ["||".join(str(v) for v in row if v is not None) for row in rows]


def test_row_checksum(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA + ", `Row_Inserted-By` string")
    stamped = row_checksum(df)
    assert stamped.columns[-2:] == ["Row_Inserted-By", "Row_Checksum"]
    assert [r["Row_Checksum"] for r in stamped.collect()] == [sha(t) for t in row_texts(ROWS)]
    assert values(row_checksum(stamped)) == values(stamped)


def test_strict_row_checksum_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a||b", None, None)], "x string, y string, z string")
    loose = {r["Row_Checksum"] for r in row_checksum(df).collect()}
    strict = {r["Row_Checksum"] for r in row_checksum(df, strict=True).collect()}
    assert (len(loose), len(strict)) == (1, 3)


def additive_digest(rows):
    sums = [0] * 16
    for text in row_texts(rows):
        digest = sha(text)
        for quarter in range(4):
            number = int(digest[16 * quarter : 16 * quarter + 15], 16)
            for at in range(4):
                sums[4 * quarter + at] += (number >> 15 * at) & 0x7FFF
    return sha(",".join(str(n) for n in (len(rows), *sums)))


def tree_digest(rows):
    texts = row_texts(rows)
    copies = {sha(t): texts.count(t) for t in texts}
    level = [(h[:6], f"{h}:{n}") for h, n in copies.items()]
    for digits in (4, 2, 0):
        groups = {}
        for prefix, digest in level:
            groups.setdefault(prefix, []).append(digest)
        level = [(p[:digits], f"{p}:{sha(','.join(sorted(ds)))}") for p, ds in groups.items()]
    return sha(",".join(sorted(d for _, d in level)))


@pytest.mark.parametrize(
    ("mode", "brute"),
    [("additive", additive_digest), ("tree", tree_digest)],
)
def test_dataset_checksum(spark, mode, brute):
    rows = ROWS + [(i, f"s{i % 7}", "z") for i in range(300)]
    expected = brute(rows)
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3 + seed)
        assert values(dataset_checksum(df, mode)) == [(expected, mode)]
    changed = [*rows[1:], (rows[0][0], "other", "z")]
    assert dataset_checksum(spark.createDataFrame(changed, SCHEMA), mode).first()[0] != expected
    fewer = spark.createDataFrame(rows[1:], SCHEMA)
    assert dataset_checksum(fewer, mode).first()[0] != expected
    twice = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    assert dataset_checksum(twice, mode).first()[0] != expected
    nothing = spark.createDataFrame([], SCHEMA)
    assert dataset_checksum(nothing, mode).first()[0] is None


def test_unknown_modes_raise(spark):
    for mode in ("md5", "compat", "auto"):
        with pytest.raises(ValueError, match="unknown checksum mode"):
            dataset_checksum(spark.createDataFrame(ROWS, SCHEMA), mode)


def test_additive_checksum_shuffles_no_rows(spark, sf_dir):
    text = plan(dataset_checksum(spark.read.parquet(f"{sf_dir}/events.parquet")))
    assert text.count("Exchange") == 1
    assert text.index("Exchange SinglePartition") < text.index("partial_sum")
