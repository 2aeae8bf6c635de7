import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from stratalift.operators import merge_rows, merge_sources


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some on NULL, some without a partner."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 11 == 1, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 40).cast("int"))
    )
    return spark.range(0, 3000, numPartitions=6).select(key.alias("k"), "id")


@pytest.fixture(scope="module")
def partners(spark):
    rows = [(k, f"p{n}") for k in range(20) for n in range(1 + (k == 7))] + [(None, "null")]
    return spark.createDataFrame(rows, "k int, p string")


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_salting_changes_nothing(skewed, partners, how):
    plain = merge_sources(skewed, partners, ["k"], how)
    salted = merge_sources(skewed, partners, ["k"], how, salts=5)
    native = skewed.join(partners, "k", how)
    assert values(plain) == values(native)
    assert values(salted) == values(native)
    assert salted.columns == native.columns


def test_salting_spreads_a_hot_key_of_equal_rows(spark):
    copies = spark.range(0, 800, numPartitions=8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    other = spark.createDataFrame([(1, "p")], "k int, p string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = merge_sources(copies, other, ["k"], salts=16)
        homes = joined.select(F.spark_partition_id()).distinct().count()
        assert joined.count() == 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert homes > 1


def test_no_side_is_hinted(skewed, partners):
    assert "hint" not in merge_sources(skewed, partners, ["k"])._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize("how", ["semi", "anti"])
def test_semi_and_anti_joins_split_hot_keys(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = spark.range(0, 100_000, 1, 8).select(
            F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")).alias("k"), "id"
        )
        other = spark.range(0, 50_000, 1, 4).select((F.col("id") * 2 + 1).alias("k"))
        joined = merge_sources(hot, other.unionByName(other), ["k"], how)
        found = joined.collect()
        text = plan(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in text
    matches = sum(i % 5 > 0 or i % 2 == 1 for i in range(100_000))
    assert len(found) == (matches if how == "semi" else 100_000 - matches)


def test_bad_merges_raise(spark, skewed, partners):
    with pytest.raises(ValueError, match="join kind"):
        merge_sources(skewed, partners, ["k"], "cross")
    with pytest.raises(ValueError, match="both sources have"):
        merge_sources(skewed, partners.withColumn("id", F.lit(1)), ["k"])


def test_merge_rows_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert values(merge_rows(a, b, a)) == [(1, "x", None), (1, "x", None), (None, "y", 2.0)]
