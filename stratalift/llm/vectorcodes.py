"""Short codes for vectors: product quantisation with codebooks searched by a GNAT.

A vector of whole numbers is cut into equal parts, and each part is named by the
nearest entry of that position's codebook. The codebooks start as the parts of
the vectors of the smallest ids and move to the mean of what is nearest to them,
for a fixed number of rounds over all vectors. A round is one pass: tasks sum
up what they assign, so that only sums per codebook entry are shuffled or reach
the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.llm.frames import column, free_name, without
from stratalift.llm.gnat import Search

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BATCH_ROWS = 10_000


def whole_numbers(lists: pa.Array, dimension: int, scale: int = SCALE, parts: int = PARTS):
    """Which vectors are kept, and ``floor(scale * x)`` of their components as rows.

    Kept are those of the dimension without NULL, NaN or infinite components. Rows are
    filled up with zeros to a multiple of ``parts``, which changes no distance.
    Components are clamped to what squared distances in 64 bits allow.
    """
    sized = np.asarray(lists.is_valid()) & (_lengths(lists) == dimension)
    flat = lists.filter(pa.array(sized)).flatten()
    # a NULL becomes NaN here
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    values = values.reshape(-1, dimension)
    sound = np.isfinite(values).all(axis=1)
    kept = sized.copy()
    kept[sized] = sound
    most = int((2.0**61 / max(1, dimension)) ** 0.5)
    with np.errstate(over="ignore"):
        found = np.clip(np.floor(scale * values[sound]), -most, most).astype(np.int64)
    return kept, np.pad(found, ((0, 0), (0, -dimension % parts)))


def _lengths(lists: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.list_value_length(lists).fill_null(-1))


class Codebooks:
    """``entries[part]``: the rows of a part's codebook, in the order of their indexes."""

    def __init__(self, entries: list[np.ndarray], dimension: int, scale: int = SCALE) -> None:
        self.entries, self.dimension, self.scale = entries, dimension, scale
        self.searches = [Search(e) for e in entries]

    @property
    def parts(self) -> int:
        return len(self.entries)

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, per row and part."""
        indexes = np.empty((len(rows), self.parts), np.int64)
        errors = np.empty((len(rows), self.parts), np.int64)
        for part, (points, search) in enumerate(zip(self.cut(rows), self.searches, strict=True)):
            indexes[:, part], errors[:, part] = search.nearest(points)
        return indexes, errors

    def cut(self, rows: np.ndarray) -> list[np.ndarray]:
        return np.split(rows, self.parts, axis=1)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, as decimals with commas between."""
        every = ",".join(str(int(x)) for e in self.entries for x in e.ravel())
        return hashlib.sha256(every.encode()).hexdigest()

    def moved(self, sums: dict[tuple[int, int, int], int]) -> Codebooks:
        """Each entry at ``floor(sum / count)`` of its parts; entries without parts stay.

        ``sums`` is keyed by part, entry and place, where place -1 is the count.
        """
        books = [e.copy() for e in self.entries]
        for part, book in enumerate(books):
            for entry in range(len(book)):
                if count := sums.get((part, entry, -1), 0):
                    book[entry] = [sums.get((part, entry, k), 0) // count for k in range(book.shape[1])]
        return Codebooks(books, self.dimension, self.scale)


def first_codebooks(
    df: DataFrame, vec_id: str, vector: str, parts: int, entries: int, scale: int
) -> Codebooks | None:
    """From the vectors of the smallest ids; None where no id has a vector to keep."""
    sound = F.forall(F.col("v"), lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    given = df.select(column(vec_id).alias("id"), column(vector).alias("v"))
    given = given.where(F.col("id").isNotNull() & (F.size("v") > 0) & sound)
    ids = [r["id"] for r in given.select("id").distinct().orderBy("id").limit(entries).collect()]
    if not ids:
        return None
    # of repeated rows of an id the smallest vector counts
    rows = given.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    dimension = len(rows[0]["v"])
    lists = pa.array([list(map(float, r["v"])) for r in rows], pa.list_(pa.float64()))
    _, numbers = whole_numbers(lists, dimension, scale, parts)
    return Codebooks(np.split(numbers, parts, axis=1), dimension, scale)


def fit_codebooks(
    df: DataFrame,
    vec_id: str,
    vector: str,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """The codebooks after ``rounds`` passes over all vectors.

    The vector of the smallest id sets the dimension. Vectors of another one, NULL
    ones and those with NULL, NaN or infinite components take no part. A row with a
    NULL id is assigned but starts no entry; repeated rows count each. With fewer ids than
    ``entries`` the codebooks are that much smaller, without any there are none (None).
    """
    books = first_codebooks(df, vec_id, vector, parts, entries, scale)
    if books is None:
        return None
    for _ in range(rounds):
        shared = df.sparkSession.sparkContext.broadcast(books)  # parts * entries rows
        summed = (
            df.select(column(vector).alias("v"))
            .mapInArrow(_summing(shared), "part int, entry int, place int, total long")
            .groupBy("part", "entry", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        )
        sums = {(r["part"], r["entry"], r["place"]): int(r["total"]) for r in summed.collect()}
        shared.destroy()
        books = books.moved(sums)
    return books


def _summing(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        totals = [np.zeros((len(e), e.shape[1] + 1), np.int64) for e in books.entries]
        for batch in batches:
            for some in _pieces(batch):
                _, rows = whole_numbers(some.column(0), books.dimension, books.scale, books.parts)
                indexes, _ = books.assign(rows)
                for part, points in enumerate(books.cut(rows)):
                    np.add.at(totals[part], indexes[:, part], np.pad(points, ((0, 0), (1, 0)), constant_values=1))
        for part, total in enumerate(totals):
            entry, place = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(total.size, part), pa.int32()),
                    "entry": pa.array(entry.ravel(), pa.int32()),
                    "place": pa.array(place.ravel() - 1, pa.int32()),
                    "total": pa.array(total.ravel(), pa.int64()),
                }
            )

    return sums


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


def encode(df: DataFrame, vector: str, books: Codebooks | None) -> DataFrame:
    """The rows whose vector is kept, with ``code`` and ``error``.

    ``code`` has the index of each part's entry as two hexadecimal digits (as many
    as the largest index needs, if more), ``error`` is the squared distance summed over
    parts. Columns of these names are replaced, all others are kept. Without
    codebooks there are no rows.
    """
    given = without(df, "code", "error")
    fields = [*given.schema.fields, *T.StructType.fromDDL("code string, error long").fields]
    schema = T.StructType(fields)
    if books is None:
        return given.where("false").select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    place = given.columns.index(vector)
    shared = df.sparkSession.sparkContext.broadcast(books)
    digits = max(2, len(f"{max(len(e) for e in books.entries) - 1:x}"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        for batch in batches:
            for some in _pieces(batch):
                kept, rows = whole_numbers(some.column(place), books.dimension, books.scale, books.parts)
                indexes, errors = books.assign(rows)
                code = ["".join(f"{k:0{digits}x}" for k in row) for row in indexes.tolist()]
                made = [pa.array(code, pa.string()), pa.array(errors.sum(axis=1), pa.int64())]
                held = some.filter(pa.array(kept))
                names = [*some.schema.names, "code", "error"]
                yield pa.RecordBatch.from_arrays([*held.columns, *made], names=names)

    return given.mapInArrow(codes, schema)


def with_label_error(df: DataFrame, label: str) -> DataFrame:
    """The rows with ``label_error``: ``error`` summed over rows of the same label, NULLs together."""
    given = without(df, "label_error")
    own, null = free_name(given, "__label"), free_name(given, "__null")
    key = [F.coalesce(column(label).cast("string"), F.lit("")).alias(own), column(label).isNull().alias(null)]
    sums = given.groupBy(*key).agg(F.sum("error").alias("label_error"))
    return given.withColumns({own: key[0], null: key[1]}).join(sums, [own, null]).drop(own, null)
