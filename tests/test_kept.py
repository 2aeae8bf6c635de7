import os
import random
from datetime import datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from stratalift.operators import (
    dedupe,
    different_leaves,
    digest_tree,
    distinct_values,
    group_agg,
    merge_asof,
    merge_ranges,
    merge_sources,
    row_checksum,
    row_differences,
    upsert,
    upsert_counts,
)
from stratalift.operators import nearest
from stratalift.plans import ColumnSpec, FileLayer, MergeStep, RunOptions, TableSpec, transfer
from stratalift.plans.sketches import keep_sketches, unique_over
from stratalift.plans.states import keep_states, kept_group_agg
from stratalift.plans.upkeep import refresh_gold, upsert_layer
from stratalift.sinks import dated_snapshot, publish_layer, write_bucketed, write_clustered, write_layer
from stratalift.sources import read_dated, read_layer
from stratalift.streaming import land_arrivals, read_arrivals

ROWS = "k string, n int, v string"


def test_differences(spark, either_ansi):
    left = spark.createDataFrame(
        [("a", 1, "x"), ("b", 1, None), ("c", 1, "x"), ("c", 1, "x"), (None, 1, "x"), ("e", 1, "x"), ("f", 1, "1")], ROWS
    )
    right = spark.createDataFrame(
        [("a", 1, "x"), ("b", None, "1"), ("c", 1, "x"), (None, 2, "x"), ("g", 1, "x"), ("f", 1, "1")], ROWS
    )
    expected = [("None", "changed", 1, 1), ("b", "changed", 1, 1), ("c", "changed", 2, 1), ("e", "only left", 1, 0), ("g", "only right", 0, 1)]
    got = row_differences(left, right, ["k"], digits=2)
    assert got.columns == ["k", "kind", "left_rows", "right_rows"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected
    assert row_differences(left, left.orderBy(F.rand(1)), ["k"]).count() == 0
    empty = left.limit(0)
    assert row_differences(empty, empty, ["k"]).count() == 0
    assert {r["kind"] for r in row_differences(empty, right, ["k"]).collect()} == {"only right"}
    with pytest.raises(ValueError, match="same columns"):
        row_differences(left, right.drop("v"), ["k"])


def test_only_leaves_that_differ_are_read_again(spark):
    left = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    right = left.withColumn("v", F.when(F.col("k").isin(5, 900), -1).otherwise(F.col("v")))
    trees = [digest_tree(df, ["k"], digits=3) for df in (left, right)]
    leaves = different_leaves(*trees, digits=3)
    assert 1 <= leaves.count() <= 2
    assert trees[0].where("depth = 0").first()["n"] == 2000
    found = row_differences(left, right, ["k"], *trees, digits=3)
    assert values(found) == [(5, "changed", 1, 1), (900, "changed", 1, 1)]
    # rows meet the leaves before they meet a shuffle
    text = plan(found)
    assert text.index("BroadcastHashJoin") > text.index("Exchange hashpartitioning(key")
    assert "SortMergeJoin" not in text


def test_upsert(spark, either_ansi):
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), (None, 1, "z"), ("d", 4, "w")], ROWS)
    known = upsert(None, first, ["k"], "one", "2025-01-01 00:00:00").drop("Row_Change")
    known = known.withColumn("old", F.lit("o"))
    later = spark.createDataFrame(
        [("a", 1, "x", 0.5), ("a", 1, "x", 0.5), ("b", None, "1", 0.5), (None, 1, "z", None), ("e", 1, "n", 0.5)], ROWS + ", more double"
    )
    merged = upsert(known, later.withColumn("Row_Checksum", F.lit("c")), ["k"], "two", "2025-01-02 00:00:00")
    assert merged.columns[:5] == ["k", "n", "v", "more", "old"] and merged.columns[-1] == "Row_Change"
    got = {r["k"]: r for r in merged.collect()}
    assert {k: r["Row_Change"] for k, r in got.items()} == {
        "a": "changed", "b": "changed", None: "equal", "d": "gone", "e": "inserted",
    }
    one, two = datetime(2025, 1, 1), datetime(2025, 1, 2)
    for k, inserted, updated in (("a", one, two), (None, one, one), ("d", one, one), ("e", two, two)):
        assert (got[k]["Row_Inserted-On"], got[k]["Row_Updated-On"]) == (inserted, updated)
        assert (got[k]["Row_Inserted-By"], got[k]["Row_Updated-By"]) == tuple("one" if t == one else "two" for t in (inserted, updated))
    assert (got["d"]["v"], got["d"]["more"], got["d"]["old"]) == ("w", None, "o")
    assert (got["b"]["n"], got["b"]["v"], got["b"]["old"]) == (None, "1", "o") and got["e"]["old"] is None
    assert upsert_counts(merged).first().asDict() == {"inserted": 1, "changed": 2, "equal": 1, "gone": 1}
    dropped = upsert(known, later, ["k"], "two", keep_gone=False)
    assert "d" not in {r["k"] for r in dropped.collect()}
    again = upsert(merged.drop("Row_Change"), later, ["k"], "three", "2025-01-03 00:00:00")
    assert upsert_counts(again).first()["equal"] == 4
    assert {r["Row_Change"] for r in upsert(known, later.limit(0), ["k"], "two").collect()} == {"gone"}
    assert upsert(known.limit(0), later, ["k"], "two").count() == 4


def test_a_failed_publication_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "layer")
    publish_layer(spark.range(10), path)
    fails = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        publish_layer(fails, path)
    assert read_layer(spark, path).count() == 10
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 1
    # readers of the version before go on while the next is made of it
    before = read_layer(spark, path)
    publish_layer(read_layer(spark, path).where("id < 4"), path)
    assert before.count() == 10 and read_layer(spark, path).count() == 4
    for n in range(3):
        publish_layer(spark.range(n), path, keep=0)
    assert read_layer(spark, path).count() == 2
    assert sorted(n.split("-")[0] for n in os.listdir(path) if not n.startswith(".")) == ["_current", "version"]
    publish_layer(spark.range(5).limit(0), path)
    assert read_layer(spark, path).columns == ["id"] and read_layer(spark, path).count() == 0


def test_published_days(spark, tmp_path):
    path = str(tmp_path / "dated")
    for day, n in (("2025-01-01", 3), ("2025-01-02", 4), ("2025-01-01", 5)):
        dated_snapshot(spark.range(n), path, day, publish=True)
    assert read_dated(spark, path, "2025-01-01").count() == 5 and read_dated(spark, path).count() == 4
    write_layer(spark.range(2), str(tmp_path / "plain"))
    assert read_layer(spark, str(tmp_path / "plain")).count() == 2


def test_kept_states(spark, tmp_path, either_ansi):
    schema = "g string, whole int, exact decimal(10,2), real double"
    rows = [("a", 1, 1.25, 0.5), ("a", 2, None, 1.5), ("b", None, 2.5, None), (None, 7, 1.0, 2.0), ("a", 1, 1.25, 0.5)]
    rows = [(g, n, None if x is None else Decimal(str(x)), y) for g, n, x, y in rows]
    days = [spark.createDataFrame(part, schema) for part in (rows[:2], rows[2:4], rows[4:])]
    aggs = {f"{c}:{c}_{w}": w for c in ("whole", "exact", "real") for w in ("SUM", "AVG", "MIN", "MAX", "COUNT")}
    path = str(tmp_path / "states")
    for n, day in enumerate(days):
        keep_states(day, path, f"2025-01-0{n + 1}", ["g"], aggs)
    whole = group_agg(days[0].unionByName(days[1]).unionByName(days[2]), ["g"], aggs)
    kept = kept_group_agg(spark, path, ["g"], aggs)
    assert values(kept) == values(whole) and kept.dtypes == whole.dtypes
    keep_states(days[1].limit(0), path, "2025-01-02", ["g"], aggs)  # taken out again
    assert values(kept_group_agg(spark, path, ["g"], aggs)) == values(group_agg(days[0].unionByName(days[2]), ["g"], aggs))
    with pytest.raises(ValueError, match="unknown aggregate"):
        keep_states(days[0], path, "2025-01-04", ["g"], {"whole": "MEDIAN"})


def test_arrivals_are_landed_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))

    def arrive(*ids):
        spark.createDataFrame([(i, None if i % 2 else "v") for i in ids], "id long, v string").coalesce(1).write.mode("append").parquet(source)

    arrive(5, 6)
    assert land_arrivals(spark, source, target, progress) == 2
    assert land_arrivals(spark, source, target, progress) == 0
    arrive(1, 2, 2)
    arrive(3)
    assert land_arrivals(spark, source, target, progress, files_per_batch=1) == 4
    arrive()
    arrive(0)
    # what a batch that was not ended left behind is not read
    spark.range(99, 100).select("id", F.lit("x").alias("v")).write.mode("append").parquet(str(tmp_path / "stray"))
    stray = next(n for n in os.listdir(tmp_path / "stray") if n.endswith(".parquet"))
    os.link(tmp_path / "stray" / stray, f"{target}/part-stray.parquet")
    land_arrivals(spark, source, target, progress)
    assert sorted(r["id"] for r in read_arrivals(spark, target).collect()) == [0, 1, 2, 2, 3, 5, 6]


def latest(left, right, allow_equal=True):
    out = []
    for key, at in left:
        fit = [r for r in right if key is not None and at is not None and r[0] == key and r[1] is not None and (r[1] < at or allow_equal and r[1] == at)]
        best = max(fit, key=lambda r: (r[1], r[2])) if fit else (None, None, None)
        out.append((key, at, best[1], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [1, 7, 1000])
@pytest.mark.parametrize("allow_equal", [True, False])
def test_asof_against_all_pairs(spark, bucket, allow_equal):
    dice = random.Random(bucket)
    left = [(dice.choice(["a", "b", None]), dice.choice([None, *range(60)])) for _ in range(150)]
    right = [(dice.choice(["a", "b", "c", None]), dice.choice([None, *range(0, 60, 3)]), n) for n in range(60)]
    a = spark.createDataFrame(left, "k string, at int")
    b = spark.createDataFrame(right, "k string, seen int, id int")
    found = merge_asof(a, b, ["k"], "at", "seen", bucket, allow_equal)
    assert found.columns == ["k", "at", "seen", "id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == latest(left, right, allow_equal)
    none = merge_asof(a, b.limit(0), ["k"], "at", "seen", bucket)
    assert none.count() == 150 and none.where("id is not null").count() == 0
    assert merge_asof(a.limit(0), b, ["k"], "at", "seen", bucket).count() == 0


def test_asof_spreads_a_hot_key(spark):
    a = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    b = spark.range(0, 1000, 10).select(F.lit(1).alias("k"), F.col("id").alias("seen"), F.create_map(F.lit("x"), "id").alias("m"))
    found = merge_asof(a, b, ["k"], "at", "seen", 50)
    assert "hashpartitioning(__key0" in plan(found) and "__bucket" in plan(found)
    assert all(r["seen"] == r["at"] // 10 * 10 and r["m"] == {"x": r["seen"]} for r in found.collect())
    with pytest.raises(ValueError, match="width"):
        merge_asof(a, b, ["k"], "at", "seen")
    with pytest.raises(ValueError, match="both sides"):
        merge_asof(a, b.withColumnRenamed("seen", "at"), ["k"], "at", "at", 5)


@pytest.mark.parametrize("width", [1, 10, 500])
def test_ranges_against_all_pairs(spark, width):
    dice = random.Random(3)
    left = [(dice.choice("ab"), dice.choice([None, *range(-50, 50)])) for _ in range(80)]
    right = [(dice.choice(["a", "b", None]), low, low + dice.choice([0, 1, 10, 10, 40]), n) for n, low in enumerate(range(-60, 60, 4))]
    right += [("a", None, 5, 100), ("a", 5, None, 101), ("a", 9, 3, 102)]
    a = spark.createDataFrame(left, "k string, at int")
    b = spark.createDataFrame(right, "k string, low int, high int, id int")
    pairs = [
        (k, at, low, high, n) for k, at in left for k2, low, high, n in right
        if k == k2 and None not in (at, low, high) and low <= at < high
    ]
    assert values(merge_ranges(a, b, ["k"], "at", "low", "high", width)) == sorted(pairs, key=repr)
    outer = merge_ranges(a, b, ["k"], "at", "low", "high", width, "left")
    alone = [p for p in left if not any(p == q[:2] for q in pairs)]
    assert outer.count() == len(pairs) + len(alone)
    assert merge_ranges(a, b.limit(0), ["k"], "at", "low", "high", width).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_ranges_of_one_key_go_to_many_tasks(spark, monkeypatch, how):
    monkeypatch.setattr(nearest, "PIECE_PAIRS", 200)
    monkeypatch.setattr(nearest, "PIECE_RANGES", 8)
    dice = random.Random(5)
    left = [("a", dice.choice([None, 7, *range(30)])) for _ in range(150)] + [("b", 3), (None, 3), ("c", 900)] * 2
    right = [("a", low, low + dice.choice([0, 5, 40])) for low in [*range(30), *[9] * 30]] + [("b", 0, 9), (None, 0, 9)]
    rows = spark.createDataFrame(left, "k string, at int").coalesce(1)
    spans = spark.createDataFrame(right, "k string, low long, high long").coalesce(1)
    expected = []
    for k, at in left:
        met = [(k, at, low, high) for k2, low, high in right if None not in (k, at) and k == k2 and low <= at < high]
        expected += met or ([(k, at, None, None)] if how == "left" else [])
    found = merge_ranges(rows, spans, ["k"], "at", "low", "high", 20, how)
    assert values(found) == sorted(expected, key=repr)
    # tables of one task each, and one key, still make pairs in all tasks
    tasks = found.where("k = 'a'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 0.6 * len(expected)


def test_ranges_of_keys_of_other_types(spark, monkeypatch, either_ansi):
    monkeypatch.setattr(nearest, "PIECE_PAIRS", 20)
    monkeypatch.setattr(nearest, "PIECE_RANGES", 4)
    rows = spark.range(60).selectExpr("cast(id % 2 as int) n", "id % 3 f", "cast(id % 5 as string) t", "id at", "map('x', id) m")
    spans = spark.range(40).selectExpr("id % 2 n", "cast(id % 3 as double) f", "cast(id % 5 as int) t", "id low", "id + 9 high")
    expected = [(i, j) for i in range(60) for j in range(40) if all(i % d == j % d for d in (2, 3, 5)) and j <= i < j + 9]
    for on in (["n", "f", "t"], ["t"]):
        low = spans.select(*on, "low", "high")
        pairs = expected if len(on) == 3 else [(i, j) for i in range(60) for j in range(40) if i % 5 == j % 5 and j <= i < j + 9]
        found = merge_ranges(rows, low, on, "at", "low", "high", 10)
        assert sorted((r["at"], r["low"]) for r in found.collect()) == pairs


def test_maps_in_any_order_are_equal(spark, either_ansi):
    schema = "id int, m map<string,struct<a:int,n:map<int,string>>>, l array<map<string,int>>"
    first = (1, {"x": (1, {1: "p", 2: "q"}), "y": None}, [{"a": 1, "b": 2}, None])
    second = (1, {"y": None, "x": (1, {2: "q", 1: "p"})}, [{"b": 2, "a": 1}, None])
    df = spark.createDataFrame([first, second, (2, None, None), (2, None, None), (3, {}, [])], schema)
    digests = row_checksum(df).groupBy("Row_Checksum").count()
    assert sorted(r["count"] for r in digests.collect()) == [1, 2, 2]
    assert sorted(r["count"] for r in row_checksum(df, strict=True).groupBy("Row_Checksum").count().collect()) == [1, 2, 2]
    unique = dedupe(df)
    assert sorted(r["id"] for r in unique.collect()) == [1, 2, 3] and unique.schema == df.schema
    assert dedupe(df, ["m"]).count() == 3 and distinct_values(df, "l").count() == 3
    assert dedupe(df.limit(0)).count() == 0


def test_unique_over_days(spark, tmp_path):
    path = str(tmp_path / "sketches")
    df = spark.range(3000).select((F.col("id") % 1000).alias("n"), F.when(F.col("id") % 2 == 0, F.repeat(F.lit("x"), 200)).alias("t"), (F.col("id") / 7).alias("d"))
    for day in range(1, 4):
        keep_sketches(df.where(F.col("n") % 3 == day - 1), path, f"2025-01-0{day}", ["n", "t", "d"])
    found = {r["column"]: r for r in unique_over(spark, path, "2025-01-01", "2025-01-31").collect()}
    assert found["n"]["days"] == 3 and 0 < found["n"]["error"] < 0.06
    for name, exact in (("n", 1000), ("t", 2), ("d", 3000)):
        assert abs(found[name]["estimate"] - exact) <= exact * found[name]["error"] + 1
    one = {r["column"]: r["estimate"] for r in unique_over(spark, path, "2025-01-02", "2025-01-02").collect()}
    assert abs(one["n"] - 333) <= 333 * found["n"]["error"]
    keep_sketches(df.limit(0), path, "2025-01-02", ["n", "t", "d"])
    assert {r["estimate"] for r in unique_over(spark, path, "2025-01-02", "2025-01-02").collect()} == {0}
    assert unique_over(spark, path, "2024-01-01", "2024-12-31").count() == 0
    # the rows are not looked at
    assert spark.read.parquet(path).count() == 9


def test_bucketed_tables_need_no_shuffle(spark):
    a = spark.range(500).select((F.col("id") % 60).alias("k"), "id")
    b = spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.sources.bucketing.autoBucketedScan.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_bucketed(a, "bucketed_a", ["k"], 4)
        write_bucketed(b, "bucketed_b", ["k"], 4)
        merged = merge_sources(dedupe(spark.table("bucketed_a"), ["k"], {"id": "DESC"}), spark.table("bucketed_b"), ["k"])
        text = plan(merged)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert sorted((r["k"], r["id"]) for r in merged.collect()) == [(k, k + 480 if k < 20 else k + 420) for k in range(50)]
        write_bucketed(b.limit(0), "bucketed_b", ["k"], 4)
        assert spark.table("bucketed_b").count() == 0
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"drop table if exists {name}")


def test_clustered_files_are_skipped_on_every_column(spark, tmp_path):
    dice = random.Random(9)
    rows = [(dice.randrange(10_000), f"n{dice.randrange(10_000):05}", dice.random()) for _ in range(8000)]
    rows += [(None, None, 0.5), (None, "n00001", None), (7, None, None)] + [(5, "hot", float(k)) for k in range(2000)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    path = str(tmp_path / "clustered")
    write_clustered(df, path, ["a", "b"], 32)
    assert values(read_layer(spark, path)) == values(df)
    files = [pq.ParquetFile(f"{path}/{n}") for n in os.listdir(path) if n.endswith(".parquet")]
    groups = [f.metadata.row_group(g) for f in files for g in range(f.metadata.num_row_groups)]
    spans = {n: [(s.min, s.max) for g in groups if (s := g.column(n).statistics) and s.has_min_max] for n in (0, 1)}
    for n, value in ((0, 5000), (0, 9000), (1, "n05000"), (1, "n01234")):
        met = sum(low <= value <= high for low, high in spans[n])
        assert met <= len(groups) / 2
    assert max(f.metadata.num_rows for f in files) < 3 * len(rows) / 32
    write_clustered(df.limit(0), path, ["a", "b"], 4)
    assert read_layer(spark, path).count() == 0


def test_upsert_layer(spark, tmp_path):
    place, keys = FileLayer(str(tmp_path / "layer")), ["k"]
    options = [RunOptions(f"2025-01-0{n}", run_ts=f"2025-01-0{n} 00:00:00") for n in (1, 2, 3)]
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, None)], ROWS)
    second = spark.createDataFrame([("a", 2, "x"), ("c", 1, "y"), (None, 1, "z")], ROWS)
    assert upsert_layer(spark, place, first, keys, "one", options[0]) == {"inserted": 2, "changed": 0, "equal": 0, "gone": 0}
    assert upsert_layer(spark, place, second, keys, "two", options[1]) == {"inserted": 2, "changed": 1, "equal": 0, "gone": 1}
    assert upsert_layer(spark, place, second, keys, "three", options[2], keep_gone=False) == {"inserted": 0, "changed": 0, "equal": 3, "gone": 1}
    rows = {r["k"]: (r["Row_Inserted-By"], r["Row_Updated-By"], r["n"]) for r in place.read(spark).collect()}
    assert rows == {"a": ("one", "two", 2), "c": ("two", "two", 1), None: ("two", "two", 1)}
    broken = second.withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        upsert_layer(spark, place, broken, keys, "four", options[2])
    assert place.read(spark).count() == 3
    with pytest.raises(ValueError, match="dated"):
        upsert_layer(spark, FileLayer(str(tmp_path / "d"), dated=True), first, keys, "one", options[0])


def test_refresh_gold_is_the_whole_hop(spark, tmp_path):
    spec = TableSpec(
        "web", "visits", dimensions=(ColumnSpec("k"),), metrics=(ColumnSpec("n", "integer"),),
        group_by=("name",), group_aggs={"n:total": "SUM", "n:mean": "AVG", "n:rows": "COUNT"},
    )
    names = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "A")], "k string, name string")
    days = [spark.createDataFrame(d, "k string, n int") for d in ([("a", 1), ("b", None), ("a", 5)], [("c", 3), ("zz", 9)], [])]
    merges = (MergeStep(names, ("k",), "left"),)
    states, gold = str(tmp_path / "states"), FileLayer(str(tmp_path / "gold"))
    for n, day in enumerate([days[0], days[0], *days[1:]]):
        options = RunOptions(f"2025-01-0{max(1, n)}", run_ts="2025-01-09 00:00:00", merges=merges)
        found = refresh_gold(spark, spec, day, states, gold, options)
    places = {"SL": FileLayer(str(tmp_path / "SL")), "GL": FileLayer(str(tmp_path / "GL"))}
    write_layer(days[0].unionByName(days[1]), places["SL"].path)
    whole = transfer(spark, spec, "SL", "GL", places, options)
    assert values(found) == values(whole.table) and found.columns == whole.table.columns
