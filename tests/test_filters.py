import operator
import decimal
import random
import time
from datetime import date

import pytest
from conftest import plan, values

from stratalift.functions import blank_match, local_time_text, narrow, regex_match, spark_type
from stratalift.operators import filter_condition, filter_tree
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Lipa", 20, "5", date(2025, 1, 1)),
            (2, "Batangas", 40, "30", date(2025, 1, 2)),
            (3, "Lipa", 30, "200", date(2025, 1, 3)),
            (4, None, None, None, None),
            (5, "", 0, "x", date(2025, 1, 5)),
        ],
        "id int, city string, age int, score string, day date",
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def kept(df, tree):
    return ids(filter_tree(df, tree))


def test_fold_has_no_precedence(people):
    # ((age <> 20 OR city = Lipa) AND score ...): with AND binding tighter, row 5 would stay
    tree = {
        "OR": {"==": {"id": [5]}, "!=": {"age": [20]}},
        "AND": {"==": {"city": ["Lipa"]}},
    }
    assert kept(people, tree) == [3]


def test_first_word_has_no_effect(people):
    assert kept(people, {"AND": {"==": {"id": [1]}}, "OR": {"==": {"age": [40]}}}) == [1, 2]


def test_several_values_under_and_and_or(people):
    assert kept(people, {"OR": {"==": {"city": ["Lipa", "Batangas"]}}}) == [1, 2, 3]
    assert kept(people, {"AND": {"==": {"city": ["Lipa", "Batangas"]}}}) == []
    assert kept(people, {"AND": {"!=": {"city": ["Lipa", "Batangas"]}}}) == [5]
    # a tautology for rows with a value
    assert kept(people, {"OR": {"!=": {"city": ["Lipa", "Batangas"]}}}) == [1, 2, 3, 5]


def test_null_words(people):
    assert kept(people, {"OR": {"==": {"city": ["Null"]}}}) == [4]
    assert kept(people, {"OR": {"==": {"city": [None, "Lipa"]}}}) == [1, 3, 4]
    assert kept(people, {"AND": {"!=": {"city": [None]}}}) == [1, 2, 3, 5]
    assert kept(people, {"AND": {">": {"age": [None]}}}) == []


def test_not_equal_drops_null(people):
    assert kept(people, {"AND": {"!=": {"age": [20]}}}) == [2, 3, 5]


def test_blank_means_zero_for_ranges_only(people):
    assert kept(people, {"AND": {">": {"age": [""]}}}) == [1, 2, 3]
    assert kept(people, {"AND": {">=": {"age": [""]}}}) == [1, 2, 3, 5]
    assert kept(people, {"AND": {"<": {"age": [""]}}}) == []
    assert kept(people, {"AND": {"<=": {"age": [""]}}}) == [5]
    assert kept(people, {"AND": {"==": {"city": [""]}}}) == [5]


def test_numbers_in_text_compare_as_numbers(people, either_ansi):
    assert kept(people, {"AND": {">": {"score": [9]}}}) == [2, 3]
    assert kept(people, {"AND": {"<=": {"score": [30.0]}}}) == [1, 2]


def test_text_that_does_not_fit_the_column_matches_nothing(people, either_ansi):
    assert kept(people, {"OR": {"==": {"age": ["CA", "20"]}}}) == [1]
    assert kept(people, {"AND": {">": {"day": ["2025-01-02"]}}}) == [3, 5]


def test_missing_column_is_skipped_exactly(people):
    assert kept(people, {"AND": {"==": {"CITY": ["x"], "id": [1]}}}) == [1]
    with pytest.raises(ValueError, match="no condition"):
        filter_tree(people, {"AND": {"==": {"nope": ["x"]}}})


def test_unknown_words_raise(people):
    with pytest.raises(ValueError, match="logical word"):
        filter_tree(people, {"XOR": {"==": {"id": [1]}}})
    with pytest.raises(ValueError, match="comparator"):
        filter_tree(people, {"OR": {"~": {"id": [1]}}})


def test_sets_fold_in_a_fixed_order(people):
    assert kept(people, {"OR": {"==": {"city": {"Lipa", "Batangas"}}}}) == [1, 2, 3]


def test_long_lists_become_one_in(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tree = {"OR": {"==": {"o_orderkey": list(range(0, 8000, 2))}}}
    found = filter_tree(orders, tree)
    assert found.count() == orders.where("o_orderkey < 8000 and o_orderkey % 2 = 0").count()
    assert "In(o_orderkey" in plan(found) or "INSET" in plan(found)


def test_blank_and_regex(spark):
    df = spark.createDataFrame([("",), (" \t",), ("a b",), ("ab1",), (None,)], "v string")
    blanks = df.select(blank_match(F.col("v"))).collect()
    assert [r[0] for r in blanks] == [True, True, False, False, None]
    assert [r[0] for r in df.select(regex_match(F.col("v"), "^[a-z0-9]+$")).collect()] == [
        False,
        False,
        False,
        True,
        None,
    ]


def test_local_time_text(spark):
    df = spark.sql("select timestamp_ntz '2025-01-01 05:06:07.8' as a union all select null")
    assert values(df.select(local_time_text(F.col("a")))) == [("2025-01-01 01:06:07 PM",), (None,)]


def test_narrow_keeps_values_apart(spark):
    long = "x" * 70
    looks_digested = "#" + "0" * 64
    df = spark.createDataFrame([(long,), (long + "y",), (looks_digested,), ("x",), (None,)], "v string")
    keys = [r[0] for r in df.select(narrow(df, "v")).collect()]
    assert len(set(keys)) == 5
    assert all(k is None or len(k) <= 65 for k in keys)


@pytest.mark.parametrize(
    ("name", "ddl"),
    [("integer", "int"), ("long", "bigint"), ("decimal(18,2)", "decimal(18,2)"),
     ("array<int>", "array<int>"), ("struct<a:int>", "struct<a:int>"), ("Byte", "tinyint")],
)
def test_types(spark, name, ddl):
    assert spark_type(name).simpleString() == ddl


@pytest.mark.parametrize("name", ["nonsense", "array", "map", "struct", "null", "void", "struct<>"])
def test_types_without_values_raise(spark, name):
    with pytest.raises(ValueError):
        spark_type(name)


def verdict(row, comparator, value):
    """A condition in three-valued logic: True, False or None."""
    if comparator in ("==", "!=") and value in (None, "Null"):
        return (row is None) == (comparator == "==")
    if comparator not in ("==", "!=") and value == "":
        value = 0
    if row is None or value is None:
        return None
    if isinstance(row, int) and isinstance(value, str):
        if not value.lstrip("-").isdigit():
            return None
        value = int(value)
    tests = {
        "==": row == value,
        "!=": row != value,
        ">": row > value,
        ">=": row >= value,
        "<": row < value,
        "<=": row <= value,
    }
    return tests[comparator]


def fold(row, tree):
    result, first = None, True
    for word, comparisons in tree.items():
        for comparator, columns in comparisons.items():
            for name, wanted in columns.items():
                for value in wanted:
                    one = verdict(row[name], comparator, value)
                    if first:
                        result, first = one, False
                    elif word == "OR":
                        pair = (result, one)
                        result = True if True in pair else None if None in pair else False
                    else:
                        pair = (result, one)
                        result = False if False in pair else None if None in pair else True
    return result


def test_random_trees_equal_a_fold_by_hand(spark):
    chance = random.Random(7)
    rows = [
        {"i": i, "n": chance.choice([None, -3, 0, 2, 5]), "s": chance.choice([None, "", "a", "b"])}
        for i in range(40)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "i int, n int, s string").cache()
    numbers = [None, "Null", "", 0, 2, -3, "5", "x"]
    for _ in range(40):
        tree = {}
        for word in chance.sample(["OR", "AND"], 2):
            for comparator in chance.sample(["==", "!=", ">", ">=", "<", "<="], 2):
                if comparator in ("==", "!="):
                    values = {"n": [v for v in numbers if v != ""], "s": [None, "Null", "", "a", "b"]}
                else:
                    values = {"n": numbers, "i": [3, 17, "", 30]}
                name = chance.choice(list(values))
                picked = chance.sample(values[name], chance.randint(1, 3))
                tree.setdefault(word, {}).setdefault(comparator, {})[name] = picked
        expected = [r["i"] for r in rows if fold(r, tree) is True]
        assert [r["i"] for r in filter_tree(df, tree).orderBy("i").collect()] == expected, tree
    df.unpersist()


NUMBERS = ["5", "5.0", "5.0000000001", "4.99999999999999999999", "05", "-5", "-5.5", "-0.5", ".5", "5.", "5e0", "1e30",
           "123456789012345678901234567890123", "9007199254740993", "9007199254740993.1", " 7 ", "x", "", None, "NaN", "1.2.3"]


def number(text):
    try:
        found = decimal.Decimal((text or "").strip())
    except decimal.InvalidOperation:
        return None
    return None if found.is_nan() else found


@pytest.mark.parametrize("value", [5, -5, 0, 7, 9007199254740993, 9007199254740992])
@pytest.mark.parametrize("comparator", ["==", "!=", ">", ">=", "<", "<="])
def test_whole_numbers_against_text_are_exact(spark, either_ansi, comparator, value):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    kept = {r["t"] for r in filter_tree(df, {"AND": {comparator: {"t": [value]}}}).collect()}
    compare = {"==": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
    wanted = {t for t in NUMBERS if number(t) is not None and compare[comparator](number(t), value)}
    assert kept == wanted


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double", "decimal(20,3)"])
def test_long_lists_are_one_predicate(spark, either_ansi, kind):
    df = spark.range(40).select((F.col("id") * 7).cast(kind).alias("c"), "id")
    wanted = list(range(0, 4000, 2))
    tree = filter_tree(df, {"OR": {"==": {"c": wanted}}})
    assert {r["id"] for r in tree.collect()} == set(range(0, 40, 2))
    others = filter_tree(df, {"AND": {"!=": {"c": wanted}}})
    assert {r["id"] for r in others.collect()} == set(range(1, 40, 2))


def test_lists_of_numbers_in_text(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    kept = {r["t"] for r in filter_tree(df, {"OR": {"==": {"t": [5, -5, 7, 9007199254740993, "x"]}}}).collect()}
    members = {t for t in NUMBERS if number(t) in (5, -5, 7, 9007199254740993)}
    assert kept == members | {"x"}
    left = {r["t"] for r in filter_tree(df, {"AND": {"!=": {"t": [5, -5, 7, 9007199254740993]}}}).collect()}
    assert left == {t for t in NUMBERS if number(t) is not None} - members


def test_decimal_literals_have_no_most_digits(spark, either_ansi):
    big, small = "1" + "0" * 44, "0." + "0" * 24 + "1"
    texts = [big, big + ".5", "1e30", small, "-" + small, "50.0000000000000000000000001", " 050.00 ", "-7.25", "x", None, "0", "-0"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")

    def number(text):
        return decimal.Decimal(text.strip()) if text not in ("x", None) else None

    for text in ("50.0", big, big + ".25", "1e30", small, "0", "-7.25", "50.00000000000000000000000005"):
        value = decimal.Decimal(text)
        for sign, compare in {"==": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}.items():
            wanted = [k for k, t in enumerate(texts) if number(t) is not None and compare(number(t), value)]
            assert kept(df, {"AND": {sign: {"v": [value]}}}) == wanted, (sign, text)


def test_long_lists_take_little_of_the_driver(spark):
    df = spark.range(5).select(F.col("id"), F.col("id").cast("string").alias("t"), F.col("id").cast("double").alias("d"))
    for name, values, kept in (
        ("id", list(range(3, 100_000)), [3, 4]),
        ("t", [f"it's \\{k}" for k in range(99_999)] + ["2"], [2]),
        ("t", list(range(1, 100_000)), [1, 2, 3, 4]),
        ("d", [k / 2 for k in range(6, 100_000)], [3, 4]),
    ):
        start = time.perf_counter()
        condition = filter_condition(df, {"OR": {"==": {name: values}}})
        assert time.perf_counter() - start < 3  # a call per literal takes minutes
        assert [r["id"] for r in df.where(condition).collect()] == kept
    odd = spark.createDataFrame([("a'b",), ("a\\b",), ("a\nb",), ("ä",), (None,)], "t string")
    texts = [r["t"] for r in odd.collect() if r["t"]]
    assert filter_tree(odd, {"OR": {"==": {"t": texts}}}).count() == 4
    assert filter_tree(odd, {"AND": {"!=": {"t": texts[:2]}}}).count() == 2
    mixed = spark.createDataFrame([("1",), ("x",), ("2.0",), (None,)], "t string")
    assert filter_tree(mixed, {"OR": {"==": {"t": ["x", "y", 1, 2, "Null", 7.5]}}}).count() == 4
