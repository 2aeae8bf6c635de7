import os
import random
from pathlib import Path

import pytest

from conftest import plan, values
from pyspark.sql import functions as F

from stratalift.operators import dedupe, page_rows, preview, sort_multi
from stratalift.staging import scratch, stage_rows, staging_path


def test_dedupe_all_is_idempotent_and_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "k int, v string")
    once = dedupe(df)
    assert values(once) == [(1, "a"), (1, None), (2, "a")]
    assert values(dedupe(once)) == values(once)


def test_dedupe_all_ignores_audit_columns_but_keeps_them(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, `Row_Inserted-By` string")
    assert values(dedupe(df)) == [(1, "a"), (2, "c")]


def test_dedupe_keys_takes_the_first_in_tie_break_order(spark):
    rows = [(k, v, f"t{v}") for k in range(5) for v in range(6)] + [(None, 9, "n"), (None, 8, "n")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v int, t string").repartition(7)
        first = values(dedupe(df, ["k"], {"v": "DESC"}))
        assert first == sorted([(k, 5, "t5") for k in range(5)] + [(None, 9, "n")], key=repr)
        # without a tie-break the remaining columns decide
        assert values(dedupe(df, ["k"])) == sorted(
            [(k, 0, "t0") for k in range(5)] + [(None, 8, "n")], key=repr
        )


def test_dedupe_limits_each_key_before_the_shuffle(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(dedupe(documents, ["text"], {"doc_id": "ASC"}))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_dedupe_of_maps(spark):
    df = spark.sql("select 1 as k, map('a', 1) as m union all select 1, map('b', 2)")
    assert dedupe(df, ["k"]).count() == 1


def test_sort_orders_nulls_and_ignores_other_words(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "i int, s string")
    assert [r["i"] for r in sort_multi(df, {"s": "asc", "i": "DESC"}).collect()] == [2, 3, 4, 1]
    assert [r["i"] for r in sort_multi(df, {"s": "Desc", "i": "ASC"}).collect()] == [1, 4, 3, 2]
    assert sort_multi(df, {"s": "sideways"}) is df


def test_sort_splits_a_hot_key(spark):
    df = spark.range(0, 40_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "z").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("same").alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = sort_multi(df, {"k": "ASC"})
        homes = ordered.where("k = 'z'").select(F.spark_partition_id()).distinct().count()
        keys = [r["k"] for r in ordered.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert homes > 1
    assert keys == sorted(keys)


def test_deep_pages_equal_top_k_pages(spark):
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i // 10, i, None) for i in ids], "a int, b int, c string").repartition(5)
    order = {"a": "DESC", "b": "ASC"}
    total = sorted(((i // 10, i, None) for i in ids), key=lambda r: (-r[0], r[1]))
    for offset, limit in ((0, 7), (333, 100), (995, 50), (1000, 5)):
        expected = sorted(total[offset : offset + limit], key=repr)
        assert values(page_rows(df, order, limit, offset)) == expected
        assert values(page_rows(df, order, limit, offset, top_k=0)) == expected


@pytest.mark.parametrize("word", ["ASC", "DESC"])
def test_pages_cover_ties_nulls_and_repeats_once(spark, word):
    rows = [(None if k % 7 == 0 else k % 5, "same") for k in range(200)] + [(k % 3, None) for k in range(50)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(4)
    order = {"a": word, "b": "DESC"}
    for top_k in (0, 1000):
        seen = [r for at in range(0, 260, 13) for r in values(page_rows(df, order, 13, at, top_k))]
        assert sorted(seen, key=repr) == sorted(rows, key=repr)
    for at in (0, 13, 130, 247):
        assert values(page_rows(df, order, 13, at, 0)) == values(page_rows(df, order, 13, at))


def test_deep_pages_leave_nothing_in_staging(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "stratalift"
    before = set(root.glob("*")) if root.exists() else set()
    assert page_rows(spark.range(500), {"id": "ASC"}, 5, 300, top_k=0).count() == 5
    assert set(root.glob("*")) == before


def test_preview(spark):
    assert preview(spark.range(100), 7).count() == 7


def test_scratch_deletes_what_was_staged_in_it(spark):
    kept = staging_path(spark, "kept")
    with pytest.raises(KeyError), scratch(spark):
        inner = stage_rows(spark.range(5), "inner")
        with scratch(spark):
            nested = stage_rows(spark.range(3))
            assert nested.count() == 3
        outlives = stage_rows(inner.where("id > 1"), path=kept)
        folder = inner.inputFiles()[0]
        raise KeyError
    assert outlives.count() == 3
    assert not os.path.exists(folder.removeprefix("file:")) and "/scratch-" in folder
    assert "/scratch-" not in staging_path(spark)
