"""Frame helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Texts differ a thousandfold in size, so batches are bounded by bytes and not by rows alone.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 4 << 20


def bound_batches(spark: SparkSession | None = None) -> None:
    """Arrow batches of few megabytes (a longer text is a batch of its own), unless the session
    has another bound."""
    spark = spark or SparkSession.active()
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns an operator is about to add, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[column(c) for c in df.columns if c.lower() not in gone])


def text_column(text: Column, schema: str, batch: Callable[[list[str | None]], Any]) -> Column:
    """A column that ``batch`` computes from whole texts, one Arrow batch at a time.

    For a struct schema (``a long, b double``) ``batch`` returns a dict of
    sequences, for a single type one sequence.
    """
    bound_batches()
    if " " in schema:

        def frame(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(batch([t if isinstance(t, str) else None for t in texts]))

        return F.pandas_udf(frame, schema)(text.cast("string"))

    def series(texts: pd.Series) -> pd.Series:
        values = batch([t if isinstance(t, str) else None for t in texts])
        return pd.Series(list(values), dtype=object if "<" in schema else None)

    return F.pandas_udf(series, schema)(text.cast("string"))


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a row: the crc32 of its id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sampled_labels(
    labels: DataFrame, doc_id: str, label: str, bound: int, among: Column | None = None
) -> DataFrame:
    """At most ``bound`` ids with their label: those with the lowest hashes of the id.

    Ids and labels that are NULL are left out; of several labels of an id the highest counts.
    """
    given = labels.select(column(doc_id).alias("doc_id"), column(label).alias("label"))
    given = given.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    if among is not None:
        given = given.where(among)
    one = given.groupBy("doc_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
