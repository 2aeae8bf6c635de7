"""Token id files: all documents' ids in ascending id order, Simple-8b coded in blocks.

A file set is a folder of Parquet files, so that Spark's writers and readers
reach it in any store and a task that runs again replaces its own file. A row is
a block of whole documents: ``part`` and ``block`` give its place, ``before``
the ids of the part's blocks before it, ``doc_ids`` and ``counts`` its
documents, ``words``, ``escapes`` and ``offsets`` (ids before every
``EVERY``-th word) their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.llm import simple8b
from stratalift.llm.frames import bound_batches, column
from stratalift.llm.tokens import encoder, tokenizer_content

EVERY = 128
BLOCK_IDS = 8192
# Ids are decoded in stretches of about so many.
STRETCH_IDS = 1 << 18
BLOCKS = (
    "part int, block long, before long, n_ids long, doc_ids array<{}>, counts array<long>, "
    "words binary, escapes binary, offsets binary"
)


def write_token_files(
    df: DataFrame,
    path: str,
    doc_id: str,
    text: str,
    tokenizer: str,
    end_id: int,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``.

    A NULL text is empty and gives the end id alone. NULL document ids come
    first; documents of the same id follow each other, and ids keep their type. Other columns
    are left out. A block is closed by the document that brings it to ``block_ids`` ids.
    """
    bound_batches(df.sparkSession)
    spark = df.sparkSession
    content = spark.sparkContext.broadcast(tokenizer_content(tokenizer))

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(content.value)
        part = TaskContext.get().partitionId()
        number = before = 0
        docs: list[int | None] = []
        counts: list[int] = []
        ids = [np.empty(0, np.uint32)]

        def close() -> dict:
            nonlocal number, before, docs, counts, ids
            words, escapes = simple8b.encode(np.concatenate(ids))
            block = {
                "part": part, "block": number, "before": before, "n_ids": sum(counts),
                "doc_ids": docs, "counts": counts,
                "words": words.astype("<u8").tobytes(), "escapes": escapes.astype("<u8").tobytes(),
                "offsets": simple8b.offsets(words, EVERY).astype("<u4").tobytes(),
            }
            number, before = number + 1, before + block["n_ids"]
            docs, counts, ids = [], [], [np.empty(0, np.uint32)]
            return block

        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            found, each = encode.many(texts)
            found = np.insert(found, np.cumsum(each), end_id)
            closed, start, at, held = [], 0, 0, sum(counts)
            for doc, n in zip(frame["doc_id"], (each + 1).tolist(), strict=True):
                docs.append(None if pd.isna(doc) else int(doc) if whole else doc)
                counts.append(n)
                at, held = at + n, held + n
                if held >= block_ids:
                    ids.append(found[start:at])
                    closed.append(close())
                    start, held = at, 0
            ids.append(found[start:])
            if closed:
                yield pd.DataFrame(closed)
        if docs:
            yield pd.DataFrame([close()])

    rows = df.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    whole = isinstance(kind, T.IntegralType)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInPandas(blocks, BLOCKS.format(kind.simpleString())).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType
    whole = isinstance(kind, T.IntegralType)
    # one row per part, so one window over all of them is small
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("size"))
    starts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            doc_ids, starts, ids = [], [], []
            for r in frame.itertuples(index=False):
                held = b"".join(_stretches(r))
                ends = np.cumsum(np.asarray(r.counts, np.int64))
                first = ends - r.counts
                doc_ids += r.doc_ids.tolist()
                starts.append(r.base + r.before + first)
                ids += [held[4 * a : 4 * b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": _ids(doc_ids) if whole else doc_ids,
                    "start": np.concatenate([np.empty(0, np.int64), *starts]),
                    "n_tokens": [len(i) // 4 for i in ids],
                    "ids": ids,
                }
            )

    based = files.join(F.broadcast(starts), "part").select(
        "base", "before", "n_ids", "doc_ids", "counts", "words", "escapes", "offsets"
    )
    schema = f"doc_id {kind.simpleString()}, start long, n_tokens long, ids binary"
    return based.mapInPandas(documents, schema)


def _ids(doc_ids: list) -> pd.Series:
    return pd.Series([None if pd.isna(d) else int(d) for d in doc_ids], dtype="Int64")


def _stretches(block) -> Iterator[bytes]:
    """A block's ids as bytes. The offsets say which words hold a stretch, so that what decoding
    takes is bounded also in the block of one very long document."""
    words, escapes = np.frombuffer(block.words, "<u8"), np.frombuffer(block.escapes, "<u8")
    before = np.frombuffer(block.offsets, "<u4").astype(np.int64)
    escaped = np.concatenate([[0], np.cumsum((words >> np.uint64(60)) == simple8b.ESCAPE)])
    first = 0
    while first < len(before):
        last = max(first + 1, int(np.searchsorted(before, before[first] + STRETCH_IDS, "right")) - 1)
        ends = int(before[last]) if last < len(before) else block.n_ids
        begin, end = first * EVERY, min(last * EVERY, len(words))
        own = escapes[escaped[begin] : escaped[end]]
        yield simple8b.decode(words[begin:end], own, ends - int(before[first])).astype("<u4").tobytes()
        first = last
