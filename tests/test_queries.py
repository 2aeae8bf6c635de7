"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# One row each by design; all others must return something at every scale.
NAMES = sorted(entry_points.oracle_sql())


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in at) for row in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, oracle, name):
    df = entry_points.queries()[name](spark, sf_dir)
    rows = ordered([tuple(r) for r in df.collect()], df.columns)
    assert rows
    sql = entry_points.oracle_sql()[name]
    answer = oracle.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    expected = ordered(answer.fetchall(), columns)
    assert len(rows) == len(expected)
    for row, wanted in zip(rows, expected, strict=True):
        assert all(map(same, row, wanted)), (row, wanted)


def test_every_query_has_sql():
    """Only those of the optional text operators may lack it; they have tests of their own."""
    names, with_sql = set(entry_points.queries()), set(entry_points.oracle_sql())
    assert with_sql <= names
    assert all(re.fullmatch(r"op\d+_.*|pipeline", name) for name in names - with_sql)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
