from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions import fitting_cast
from stratalift.operators import (
    audit_columns,
    audit_last,
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


def test_cast_gives_null_where_a_value_does_not_fit(spark, either_ansi):
    df = spark.createDataFrame([("1", "2025-01-31"), ("x", "2025-02-31"), (None, None)], "a string, b string")
    cast = cast_types(df, {"a": "integer", "b": "date", "missing": "long"})
    assert cast.dtypes == [("a", "int"), ("b", "date")]
    assert [r["a"] for r in cast.collect()] == [1, None, None]
    assert [str(r["b"]) for r in cast.collect()] == ["2025-01-31", "None", "None"]


def test_reformat_date_can_be_repeated(spark):
    df = spark.createDataFrame([("20250131",), ("2025-01-31",), ("",), (None,)], "d string")
    once = reformat_date(df, "d")
    expected = [("",), ("2025-01-31",), ("2025-01-31",), (None,)]
    assert values(once) == expected
    assert values(reformat_date(once, "d")) == expected


def test_concat_separator(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",), (None,)], "c string")
    assert values(concat_separator(df, "c", "/", {1: 2, 3: 2})) == [("ab/",), ("ab/cd",), (None,)]


def test_divide(spark, either_ansi):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 1)], "a int, b int")
    ratio = divide(df, "r", "a", "b")
    assert dict(ratio.dtypes)["r"] == "float"
    assert [r["r"] for r in ratio.collect()] == [0.5, None, None]
    assert divide(df, "a", "b", "b").columns == ["a", "b"]


def test_split_takes_the_separator_literally(spark, either_ansi):
    df = spark.createDataFrame([("a.b / c.d",), ("alone",), (None,)], "s string")
    parts = split_column(split_column(df, "x", "s", " / ", 0), "y", "s", " / ", 1)
    assert [(r["x"], r["y"]) for r in parts.collect()] == [("a.b", "c.d"), ("alone", None), (None, None)]
    dots = split_column(df, "x", "s", ".", 1)
    assert [r["x"] for r in dots.collect()] == ["b / c", None, None]
    assert split_column(df, "s", "s", ".", 1).columns == ["s"]


def test_replace_is_literal_and_ordered(spark):
    df = spark.createDataFrame([("a_b.",), (None,)], "v string")
    assert values(replace_text(df, "v", {"_": "XX", ".": "!", "XX!": "n"})) == [("aXXb!",), (None,)]


def test_drop_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert drop_columns(df, ["b", "zz"]).columns == ["a", "c"]
    assert rename_columns(df, {"a": "RK-a", "zz": "q"}).columns == ["RK-a", "b", "c"]
    # swapping is fine, colliding is not
    assert rename_columns(df, {"a": "b", "b": "a"}).columns == ["b", "a", "c"]
    with pytest.raises(ValueError, match="more than one column"):
        rename_columns(df, {"a": "b"})


def test_audit_columns_replace_older_stamps(spark):
    df = spark.createDataFrame([(1, "h", 2)], "a int, Row_Checksum string, b int")
    once = audit_columns(df, "me", "2025-03-01 10:20:30.9")
    twice = audit_columns(once, "you", "2025-03-02 10:20:30")
    names = ["Row_Inserted-On", "Row_Inserted-By", "Row_Updated-On", "Row_Updated-By"]
    assert once.columns == twice.columns == ["a", "b", "Row_Checksum", *names]
    row = once.first()
    assert str(row["Row_Inserted-On"]) == "2025-03-01 10:20:30"
    assert twice.first()["Row_Updated-By"] == "you"
    assert exclude_row_columns(twice).columns == ["a", "b"]


def test_audit_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Row_x int, a int, b int")
    assert audit_last(df).columns == ["a", "b", "Row_x"]


TEXTS = [
    "1", " 1 ", "\t-1\n", "+7", "1.", ".5", "-.5e-3", "1E3", "1e400", "12.5", "1d", "1f", "1L",
    "0x1p3", "NaN", "nan", "inf", "-Infinity", "+infinity", "iNf", "5-LOW", "2025-01-01", "", " ",
    "--1", "1 2", "999999999999999999999", "128", "32768", "2147483648", "١٢", " 1",
    "t", "TRUE", "yes ", "y", "no", "N", "f", "False", "0", "on", "\x7f1\x00", "1\x1f", "e", "x",
]


@pytest.mark.parametrize(
    "kind",
    ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(38,9)",
     "boolean", "date", "timestamp"],
)
def test_fitting_cast_equals_try_cast(spark, either_ansi, kind):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "v string")
    target = T.DataType.fromDDL(kind)
    pair = df.select(
        "v",
        fitting_cast(F.col("v"), T.StringType(), target).cast("string").alias("a"),
        F.col("v").try_cast(target).cast("string").alias("b"),
    )
    assert [(r.v, r.a) for r in pair.collect()] == [(r.v, r.b) for r in pair.collect()]


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_fitting_cast_of_numbers_equals_try_cast(spark, either_ansi, kind):
    edges = [s * (1 << b) + d for b in (7, 15, 31) for s in (1, -1) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in [*edges, 0, 2**63 - 1, -(2**63), None]], "v long")
    target = T.DataType.fromDDL(kind)
    pair = df.select(
        fitting_cast(F.col("v"), T.LongType(), target).alias("a"),
        F.col("v").try_cast(target).alias("b"),
    )
    assert all(r.a == r.b for r in pair.collect())


def test_text_is_read_as_nested_types(spark, either_ansi):
    texts = ["[1,2]", '[1,"x"]', "[1,null]", '{"a":1}', "abc", "", "[1,2", None, '{"a":"x","m":{"k":"v","l":3},"l":[{"d":"2020-01-01"},{"d":"q"},7]}']
    df = spark.createDataFrame([(t,) * 4 for t in [*texts, texts[1]]], "a string, m string, s string, v string")
    types = {"a": "array<int>", "m": "map<string,int>", "s": "struct<a:int,m:map<string,int>,l:array<struct<d:date>>>", "v": "variant"}
    out = cast_types(df, types)
    assert [f.dataType.simpleString() for f in out.schema] == list(types.values())
    rows = out.collect()
    assert [r["a"] for r in rows] == [[1, 2], [1, None], [1, None], *[None] * 6, [1, None]]
    assert rows[3]["m"] == {"a": 1} and rows[8]["m"] == {"a": None, "m": None, "l": None}
    assert rows[8]["s"].asDict(True) == {"a": None, "m": {"k": None, "l": 3}, "l": [{"d": date(2020, 1, 1)}, {"d": None}, None]}
    assert rows[4]["v"] is None and rows[0]["v"].toPython() == [1, 2]
    failed = dict(values(cast_failures(df, types)))
    assert failed == {
        "a": 5, "a[]": 2, "m": 7, "m{}": 3, "s": 7, "s.a": 1, "s.m": 0, "s.m{}": 1, "s.l": 0, "s.l[]": 1, "s.l[].d": 1, "v": 3,
    }
    assert set(dict(values(cast_failures(df.limit(0), types))).values()) == {0}
    assert values(cast_failures(df, {"absent": "array<int>"})) == []
    with pytest.raises(ValueError, match="text keys"):
        cast_types(df, {"m": "map<int,int>"})
