"""Sharding by longest-processing-time scheduling.

Groups of rows that must stay together go, largest first, to the shard that has
the least so far. Scheduling every group that way is one sequential pass over
all groups, so only the groups that can unbalance a shard are scheduled one by
one: those over ``total / (shards * fineness)`` bytes, of which there are fewer
than ``shards * fineness``. All others are first bundled by a hash of their key
into ``shards * fineness`` bundles, which are scheduled like groups. The driver
thus sees at most twice that many numbers however large the table is, and a
bundle is about a ``fineness``-th of a shard.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalift.llm.frames import free_name, without
from stratalift.staging import stage_rows


def least_loaded(sizes: Iterable[int], shards: int) -> list[int]:
    """The shard of each size; sizes come largest first, ties go to the lowest shard."""
    heap = [(0, shard) for shard in range(shards)]
    chosen = []
    for size in sizes:
        load, shard = heapq.heappop(heap)
        chosen.append(shard)
        heapq.heappush(heap, (load + size, shard))
    return chosen


def shard_rows(
    df: DataFrame,
    key: Column,
    size: Column,
    shards: int,
    fineness: int = 1000,
    rows_per_part: int = 10_000,
) -> DataFrame:
    """The rows with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Rows of equal ``key`` (any hashable type) share a shard; rows whose key is
    NULL form one group. A NULL or negative ``size`` counts as 0. Repeated rows
    each get a slot of their own. An empty frame gives an empty result. Columns
    named ``shard`` or ``slot`` are replaced, all others are kept.

    A slot is a number within one of several parts of the shard plus the rows
    of the parts before it, so no task numbers a whole shard.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = df.sparkSession
    id_, weight, group, bundle = (
        free_name(df, n) for n in ("__row", "__bytes", "__group", "__bundle")
    )
    units = shards * fineness
    digest = F.coalesce(F.unhex(F.sha2(key.cast("string"), 256)), F.lit(b""))
    given = without(df, "shard", "slot")
    # written once: the row number must not change when a lost task runs again
    rows = stage_rows(
        df.select(
            *[df[c] for c in given.columns],
            F.monotonically_increasing_id().alias(id_),
            F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias(weight),
            digest.alias(group),
        ).withColumn(bundle, F.pmod(F.xxhash64(group), F.lit(units)).cast("int")),
        "shards",
    )
    total, count = rows.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count(F.lit(1))).first()
    sizes = rows.groupBy(group, bundle).agg(F.sum(weight).alias(weight))
    heavy = F.col(weight) > F.lit(total // units)
    pieces = (
        sizes.select(
            F.when(heavy, F.col(group)).alias(group),
            F.when(~heavy, F.col(bundle)).alias(bundle),
            weight,
        )
        .groupBy(group, bundle)
        .agg(F.sum(weight).alias(weight))
        .collect()
    )
    pieces.sort(key=lambda p: (-p[weight], p[bundle] is None, p[bundle] or 0, p[group] or b""))
    chosen = least_loaded((p[weight] for p in pieces), shards)
    alone = [(bytes(p[group]), s) for p, s in zip(pieces, chosen, strict=True) if p[bundle] is None]
    bundled = [(p[bundle], s) for p, s in zip(pieces, chosen, strict=True) if p[bundle] is not None]
    of_group, of_bundle = free_name(df, "__of_group"), free_name(df, "__of_bundle")
    by_group = spark.createDataFrame(alone, f"`{group}` binary, `{of_group}` int")
    by_bundle = spark.createDataFrame(bundled, f"`{bundle}` int, `{of_bundle}` int")
    # both have at most shards * fineness rows
    placed = rows.join(F.broadcast(by_group), group, "left").join(
        F.broadcast(by_bundle), bundle, "left"
    )
    part, before, number = (free_name(df, n) for n in ("__part", "__before", "__number"))
    parts = max(1, math.ceil(count / shards / rows_per_part))
    placed = placed.withColumn("shard", F.coalesce(of_group, of_bundle)).withColumn(
        part, F.pmod(F.xxhash64(id_), F.lit(parts)).cast("int")
    )
    within = Window.partitionBy("shard", part)
    earlier = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", part)
        .agg(F.count(F.lit(1)).alias(number))
        .select("shard", part, F.coalesce(F.sum(number).over(earlier), F.lit(0)).alias(before))
    )
    numbered = placed.withColumn(number, F.row_number().over(within.orderBy(id_)))
    slots = numbered.join(starts, ["shard", part]).withColumn(
        "slot", F.col(before) + F.col(number) - 1
    )
    return slots.select(*given.columns, "shard", "slot")
