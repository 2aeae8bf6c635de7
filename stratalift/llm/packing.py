"""Sum-of-squares packing of documents into sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.llm.frames import bound_batches, column, free_name, without
from stratalift.llm.tokens import encoder, tokenizer_content

GROUP_PIECES = 8192


def cut_documents(
    df: DataFrame,
    doc_id: str,
    text: str,
    tokenizer: str,
    end_id: int,
    capacity: int,
    digests: bool = False,
) -> DataFrame:
    """The ids of every whole text and ``end_id``, cut every ``capacity`` ids.

    One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (the document's
    ids before it), ``length``, ``ids`` (binary, little-endian unsigned 32-bit), or with
    ``digests`` their crc32 as ``ids_crc32`` (long) in their stead, for which they do
    not leave the worker.
    A NULL text is empty: one piece with the end id. Repeated rows give repeated
    pieces, document ids keep their type, NULL ones stay NULL, other columns are left
    out. A batch holds few megabytes of text, or one text that is longer.
    """
    bound_batches(df.sparkSession)
    content = df.sparkSession.sparkContext.broadcast(tokenizer_content(tokenizer))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        for batch in batches:
            first_row = 0
            for found, each in encode.parts(batch.column("text").to_pylist()):
                held = np.insert(found, np.cumsum(each), end_id).astype("<u4")
                sizes = each + 1
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                at = 4 * ((np.cumsum(sizes) - sizes)[row] + start)
                whole = memoryview(held).cast("B")
                cuts = (whole[a : a + 4 * n] for a, n in zip(at.tolist(), length.tolist(), strict=True))
                if digests:
                    last = pa.array([zlib.crc32(c) for c in cuts], pa.int64())
                else:
                    last = pa.array([bytes(c) for c in cuts], pa.binary())
                docs = batch.column("doc_id").take(pa.array(first_row + row))
                made = [docs, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), last]
                yield pa.RecordBatch.from_arrays(made, names)
                first_row += len(sizes)

    rows = df.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    last = T.StructField(*(("ids_crc32", T.LongType()) if digests else ("ids", T.BinaryType())))
    fields = T.StructType.fromDDL("piece int, start long, length long").fields
    schema = T.StructType([rows.schema["doc_id"], *fields, last])
    names = schema.names
    return rows.mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every length.

    With ``N(g)`` open sequences of ``g`` free places, a length ``s`` goes where the
    sum of ``N(g)**2`` over all ``g`` becomes smallest: into a sequence of gap ``g``
    (one less of ``g``, one more of ``g - s``; gap 0 is closed and does not count) or
    into a new one. Equal sums take the smallest gap left. Lengths come largest first.
    """
    sequence = np.empty(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # N; N(0) stays 0
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    never = np.iinfo(np.int64).max
    for at in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[at])
        if s > capacity:
            raise ValueError(f"a length of {s} exceeds the capacity of {capacity}")
        # (N(g)-1)^2 - N(g)^2 + (N(g-s)+1)^2 - N(g-s)^2, for g from s
        change = 2 * (count[: capacity + 1 - s] - count[s:]) + 2
        change[0] -= 1
        change[count[s:] == 0] = never
        left = int(np.argmin(change))
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if change[left] != never and change[left] <= fresh:
            gap = left + s
            number = open_[gap].pop()
            count[gap] -= 1
        else:
            gap, number, made = capacity, made, made + 1
        sequence[at], offset[at] = number, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_[gap - s].append(number)
    return sequence, offset


def pack_rows(
    df: DataFrame,
    length: str,
    capacity: int,
    rows: int | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset`` (the place in it, gapless from 0).

    Rows are dealt by a hash over groups of about ``group_pieces`` rows, each
    packed on its own by ``sum_of_squares``; a group ends with a few sequences
    that are not full, so thousands of rows in a group cost next to nothing.
    ``rows`` is the number of rows below the capacity, or a bound of it; without
    it the frame is counted. A NULL or negative length counts as 0 and takes no
    place. Columns of the added names are replaced, all others are kept.
    """
    given = without(df, "sequence_id", "offset")
    if rows is None:
        rows = given.count()
    groups = max(1, math.ceil(rows / group_pieces))
    group = free_name(given, "__group")
    fields = [*given.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long").fields]
    names = [f.name for f in fields]

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        first = int(frame[group].iloc[0]) << 40
        lengths = frame[length].fillna(0).clip(lower=0).to_numpy(np.int64)
        sequence, offset = sum_of_squares(lengths, capacity)
        return frame.assign(sequence_id=first + sequence, offset=offset)[names]

    # rows of one document are dealt apart, and so are repeated rows of different partitions
    keys = [column(f.name) for f in given.schema if not isinstance(f.dataType, T.MapType)]
    spread = F.xxhash64(*keys, F.spark_partition_id())
    dealt = given.withColumn(group, F.pmod(spread, F.lit(groups)).cast("int"))
    return dealt.groupBy(group).applyInPandas(place, T.StructType(fields))
