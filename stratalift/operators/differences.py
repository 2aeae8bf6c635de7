"""Which rows of two tables differ.

Every table keeps a tree of digests: rows belong to a leaf by the hash of their
key, a node sums up the digests of all rows below it. Two trees are compared from
the root down, and only below nodes that differ; only rows of leaves that differ are
then read again. So a comparison of two large tables costs their trees, and beyond
that what changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.functions.columns import col, comparable
from stratalift.operators.integrity import row_digest
from stratalift.staging import scratch, stage_rows, staging_path

# 16^5 leaves: some 10^5 rows in each at 10^11 rows. It also bounds the leaves that may differ,
# a million numbers, which is what makes it safe to broadcast them.
LEAF_DIGITS = 5
NODE = ("n", "low", "high")
ONLY_LEFT, ONLY_RIGHT, CHANGED = "only left", "only right", "changed"


def digest_tree(df: DataFrame, keys: Sequence[str], strict: bool = True, digits: int = LEAF_DIGITS) -> DataFrame:
    """The nodes of the tree: ``depth``, ``prefix``, the number of rows and the sums of their digests.

    A node's sums are those of its children, so neither the order of rows nor copies of a key matter.
    The sums stay exact for 2^66 rows. An empty table has no nodes. ``strict`` tells a NULL from
    its neighbours' place.
    """
    leaves = _keyed(df, keys, strict, digits).groupBy("prefix").agg(*_sums("row"))
    # every leaf goes into the node of each depth above it: six rows for each of a million at most
    depths = F.explode(F.sequence(F.lit(0), F.lit(digits))).alias("depth")
    paths = leaves.select(depths, "prefix", *NODE).withColumn("prefix", F.expr("substring(prefix, 1, depth)"))
    nodes = paths.groupBy("depth", "prefix").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in NODE])
    return nodes.select("depth", "prefix", F.col("n").cast("bigint").alias("n"), "low", "high")


def write_tree(tree: DataFrame, path: str) -> None:
    """Keep a tree; a level of it is a folder of its own."""
    tree.repartition("depth").write.mode("overwrite").partitionBy("depth").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    # prefixes such as 0e5 are text, and so they are read
    return spark.read.schema("prefix string, n bigint, low decimal(38,0), high decimal(38,0), depth int").parquet(path)


def different_leaves(left: DataFrame, right: DataFrame, digits: int = LEAF_DIGITS) -> DataFrame:
    """``prefix`` of the leaves in which two trees differ.

    Level by level, and on each only the children of nodes that differ are compared.
    """
    found: DataFrame | None = None
    for depth in range(digits + 1):
        a, b = (_level(tree, depth, found) for tree in (left, right))
        same = reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in NODE])
        met = a.alias("a").join(b.alias("b"), F.col("a.prefix") == F.col("b.prefix"), "full_outer")
        unequal = met.where(~same).select(F.coalesce("a.prefix", "b.prefix").alias("prefix"))
        found = stage_rows(unequal, f"different-{depth}")
        if found.isEmpty():
            break
    return found


def _level(tree: DataFrame, depth: int, above: DataFrame | None) -> DataFrame:
    level = tree.where(F.col("depth") == depth).drop("depth")
    if above is None:
        return level
    parents = F.broadcast(above.select(F.col("prefix").alias("parent")))  # at most 16^digits
    return level.join(parents, F.substring("prefix", 1, depth - 1) == F.col("parent"), "left_semi")


def row_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_tree: DataFrame | None = None,
    right_tree: DataFrame | None = None,
    strict: bool = True,
    digits: int = LEAF_DIGITS,
) -> DataFrame:
    """The keys of every row that differs, ``kind`` and how many rows either side has of it.

    ``kind`` is ``only left``, ``only right`` or ``changed``. Rows of one key are compared as a
    whole: the key has changed if they differ in number or in any value; a NULL is a key like
    others. Trees that are given have to be those of the tables, made with the same keys, ``strict``
    and ``digits``. Columns are compared by place, so both tables have the same ones.
    """
    if left.columns != right.columns:
        raise ValueError("both tables need the same columns in the same order")
    outlives = staging_path(left.sparkSession, "different")
    with scratch(left.sparkSession):
        trees = [
            tree if tree is not None else stage_rows(digest_tree(df, keys, strict, digits), "tree")
            for df, tree in ((left, left_tree), (right, right_tree))
        ]
        leaves = stage_rows(different_leaves(*trees, digits), path=outlives)
    few = F.broadcast(leaves)  # at most 16^digits, so no row of another leaf reaches the shuffle
    sides = [
        _keyed(df, keys, strict, digits).join(few, "prefix", "left_semi").withColumn("side", F.lit(side))
        for side, df in (("left", left), ("right", right))
    ]
    # equal rows of a side are summed up before the shuffle
    counted = sides[0].unionByName(sides[1]).groupBy("key").agg(
        *[F.first(col(k)).alias(k) for k in keys], *_sums("row", "left"), *_sums("row", "right")
    )
    same = reduce(Column.__and__, [F.col(f"left_{c}") == F.col(f"right_{c}") for c in NODE])
    kind = F.when(F.col("right_n") == 0, ONLY_LEFT).when(F.col("left_n") == 0, ONLY_RIGHT).otherwise(CHANGED)
    return counted.where(~same).select(
        *[col(k) for k in keys],
        kind.alias("kind"),
        F.col("left_n").cast("bigint").alias("left_rows"),
        F.col("right_n").cast("bigint").alias("right_rows"),
    )


def _keyed(df: DataFrame, keys: Sequence[str], strict: bool, digits: int) -> DataFrame:
    values = F.struct(*[comparable(col(k), df.schema[k].dataType).alias(f"k{at}") for at, k in enumerate(keys)])
    key = F.sha2(F.to_json(values, {"ignoreNullFields": "false"}), 256)
    rows = df.select(*[col(k) for k in keys], key.alias("key"), row_digest(df, strict).alias("row"))
    return rows.withColumn("prefix", F.substring("key", 1, digits))


def _sums(digest: str, side: str | None = None) -> list[Column]:
    """The number of rows (of a side) and the sums of 60 bits of either half of their digests."""
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 33)]
    values = dict(zip(NODE, [F.lit(1).cast("decimal(38,0)"), *halves], strict=True))
    if side is None:
        return [F.sum(value).cast("decimal(38,0)").alias(name) for name, value in values.items()]
    own = {f"{side}_{name}": F.when(F.col("side") == side, value) for name, value in values.items()}
    return [F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,0)").alias(name) for name, value in own.items()]
