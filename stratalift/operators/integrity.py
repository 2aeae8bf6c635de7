"""Row and dataset checksums.

Two tables with the same rows, in any order and any partitioning, get the same
dataset checksum. Three forms of it exist; only digests of one form compare:

``additive``  the row digests are added up, part by part, and the sums hashed.
              One pass with partial sums, no shuffle of rows: the default.
``tree``      equal row digests are counted, the counted digests hashed per
              digest prefix and the prefixes folded 256 to one up to the root.
              Every group is bounded, however many copies a row has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.functions.columns import col, row_text

ROW_CHECKSUM = "Row_Checksum"
DIGEST_DIGITS = 64
# The additive form reads 15 hex digits, a 60-bit number, from each quarter of the
# digest and sums it in four parts: sums of 15-bit parts stay within a bigint for
# 2^48 rows.
QUARTERS = 4
QUARTER_DIGITS = 15
PARTS = 4
PART_BITS = 15
# 16^6 leaves: some 6,000 distinct rows in each at 10^11 rows.
TREE_DIGITS = 6
TREE_STEP = 2


def row_digest(df: DataFrame, strict: bool = False) -> Column:
    return F.sha2(row_text(df, strict), 256)


def row_checksum(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``Row_Checksum``: SHA-256 of the regular columns joined with ``||``."""
    kept = [col(c) for c in df.columns if c != ROW_CHECKSUM]
    return df.select(*kept, row_digest(df, strict).alias(ROW_CHECKSUM))


def dataset_checksum(df: DataFrame, mode: str = "additive", strict: bool = False) -> DataFrame:
    """One row ``checksum, mode``; the checksum of an empty table is NULL."""
    if mode == "additive":
        digests = df.select(row_digest(df, strict).alias("h"))
        sums = [value.alias(name) for name, value in additive_sums("h").items()]
        result = digests.agg(*sums).select(additive_digest().alias("checksum"))
    elif mode == "tree":
        result = _tree(df, strict)
    else:
        raise ValueError(f"unknown checksum mode {mode!r}")
    return result.select("checksum", F.lit(mode).alias("mode"))


def _sum_names() -> list[str]:
    return [f"sum{at}" for at in range(QUARTERS * PARTS)]


def additive_sums(digest: str) -> dict[str, Column]:
    """Aggregates of the additive form over a digest column, fit for a larger aggregation."""
    width, mask = DIGEST_DIGITS // QUARTERS, (1 << PART_BITS) - 1
    numbers = [
        f"cast(conv(substring({digest}, {1 + quarter * width}, {QUARTER_DIGITS}), 16, 10) as bigint)"
        for quarter in range(QUARTERS)
    ]
    parts = [
        f"shiftright({number}, {shift}) & {mask}"
        for number in numbers
        for shift in range(0, PARTS * PART_BITS, PART_BITS)
    ]
    sums = {name: F.expr(f"sum({part})") for part, name in zip(parts, _sum_names(), strict=True)}
    return {"digests": F.count(digest), **sums}


def additive_digest() -> Column:
    """The checksum from the columns ``additive_sums`` left."""
    parts = [F.col(n).cast("string") for n in ("digests", *_sum_names())]
    digest = F.sha2(F.concat_ws(",", *parts), 256)
    return F.when(F.col("digests") > 0, digest)


def _tree(df: DataFrame, strict: bool) -> DataFrame:
    # Copies are counted first, with map-side partial counts: 32 bytes per
    # distinct row cross the network and a leaf never holds a row twice.
    counted = (
        df.select(F.unhex(row_digest(df, strict)).alias("b"))
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lower(F.hex("b")).alias("h"), "n")
    )
    level = counted.select(
        F.substring("h", 1, TREE_DIGITS).alias("prefix"),
        F.concat_ws(":", "h", F.col("n").cast("string")).alias("digest"),
    )
    for digits in range(TREE_DIGITS - TREE_STEP, -1, -TREE_STEP):
        level = (
            level.groupBy("prefix")
            .agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("digest"))), 256).alias("d"))
            .select(
                F.substring("prefix", 1, digits).alias("prefix"),
                F.concat_ws(":", "prefix", "d").alias("digest"),
            )
        )
    root = F.array_sort(F.collect_list("digest"))
    return level.agg(
        F.when(F.count("digest") > 0, F.sha2(F.concat_ws(",", root), 256)).alias("checksum")
    )
