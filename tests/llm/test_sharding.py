import heapq
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stratalift.llm import queries, sharding


def test_least_loaded_is_longest_processing_time():
    assert sharding.least_loaded([7, 6, 5, 4, 3], 2) == [0, 1, 1, 0, 0]
    assert sharding.least_loaded([], 3) == []


def test_shards_against_plain_scheduling(spark):
    """Groups that are all heavy are placed as on paper: largest first, to the least-loaded shard."""
    dice = random.Random(5)
    sizes = {f"k{n}": dice.randrange(1, 10**6) for n in range(40)}
    data = [(k, n // 3 if part else n - 2 * (n // 3)) for k, n in sizes.items() for part in range(3)]
    out = rows(sharding.shard_rows(spark.createDataFrame(data, "k string, n long"), F.col("k"), F.col("n"), 6))
    load = Counter()
    for r in out:
        load[r["shard"]] += r["n"]
    heap = [0] * 6
    for n in sorted(sizes.values(), reverse=True):
        heapq.heappush(heap, heapq.heappop(heap) + n)
    assert sorted(load.values()) == sorted(heap)


def rows(df):
    out = df.collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))
    return out


def test_groups_stay_together_and_loads_are_near(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 900).cast("string")).alias("k"),
        (F.col("id") % 50 + 1).alias("n"),
        F.lit("x").alias("Slot"),
    )
    out = rows(sharding.shard_rows(df, F.col("k"), F.col("n"), 2, fineness=200, rows_per_part=300))
    assert len(out) == 5000 and out[0].asDict().keys() == {"k", "n", "shard", "slot"}
    where, load = defaultdict(set), Counter()
    for r in out:
        where[r["k"]].add(r["shard"])
        load[r["shard"]] += r["n"]
    assert all(len(s) == 1 for s in where.values())
    assert abs(load[0] - load[1]) <= 0.01 * sum(load.values())


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, None), (None, 3), ("a", 2), ("a", 2), ("", -5)], "k string, n int")
    out = rows(sharding.shard_rows(df, F.col("k"), F.col("n"), 3))
    assert len(out) == 5
    assert len({r["shard"] for r in out if r["k"] is None}) == 1
    assert sharding.shard_rows(df.limit(0), F.col("k"), F.col("n"), 3).collect() == []


def test_query(spark, sf_dir):
    out = rows(queries.op1_sharding(spark, sf_dir))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    for r in out:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    load, where = Counter(), defaultdict(set)
    for r in out:
        load[r["shard"]] += r["size"]
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values()) and len(load) == 24
    assert max(load.values()) <= max(1.1 * sum(load.values()) / 24, max(r["size"] for r in out))
