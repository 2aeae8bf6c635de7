"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalift.staging import stage_rows


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node of a link.

    ``links`` has the columns ``a`` and ``b`` of one type; loops, repeats and either order are
    fine. A large star hangs a node's larger neighbours on its smallest neighbour,
    a small star the smaller ones; a union-find whose tables stay distributed. Each
    round is written to the shared folder. Nodes of no link are not in the result.
    """
    edges = stage_rows(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = both.where(F.col("b") > F.col("a"))
        large = _hang(both, larger).distinct()
        # a is the larger end now, and its smaller neighbours go to the smallest of them
        own = large.groupBy("a").agg(F.min("b").alias("b"))
        edges = stage_rows(_hang(large, large).unionByName(own).distinct(), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _hang(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """The far ends ``b`` of the moved edges, each on the smallest of ``a`` and its neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    hung = moved.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.where(F.col("a") != F.col("b"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()
