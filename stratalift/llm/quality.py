"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.llm import ftrl
from stratalift.llm.frames import column, sampled_labels, text_column, without

BITS = 18
CACHED_WORDS = 300_000
# A word's shape: runs of capitals, small letters, other letters, digits; marks stay.
RUNS = ((re.compile(r"[A-Z]{2,}"), "XX"), (re.compile(r"[a-z]+"), "x"), (re.compile(r"\d+"), "0"))
SAME = np.uint64(zlib.crc32(b"same"))
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of a word (low half: lower-cased letters, high half: shape)."""

    def __missing__(self, word: str) -> int:
        shape = word
        for run, mark in RUNS:
            shape = run.sub(mark, shape)
        plain = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        value = zlib.crc32(shape.encode("utf-8", "surrogatepass")) << 32 | plain
        self[word] = value
        return value


WORDS = _Words()


def features(text: str | None, bits: int = BITS) -> ftrl.Example:
    """Places and values of the words, their shapes and the pairs of both.

    A pair of equal words has one place whatever the word. Counts are scaled to
    length 1, so long texts weigh as much as short ones.
    """
    if len(WORDS) >= CACHED_WORDS:
        WORDS.clear()
    words = (text or "").split()
    codes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0)
    plain, shape = codes & np.uint64(0xFFFFFFFF), codes >> np.uint64(32)
    pair = np.where(plain[1:] == plain[:-1], SAME, plain[1:] * MIX + plain[:-1])
    shapes = shape[1:] * MIX + shape[:-1]
    seeded = [part + np.uint64(k << 40) for k, part in enumerate((plain, shape, pair, shapes), 1)]
    mixed = np.concatenate(seeded) * MIX
    places, counts = np.unique(mixed >> np.uint64(64 - bits), return_counts=True)
    values = counts.astype(float)
    return places.astype(np.int64), values / np.sqrt(values @ values)


def score(text: str | None, weights: np.ndarray, bits: int = BITS) -> float:
    places, values = features(text, bits)
    return float(ftrl.sigmoid(weights[places] @ values + weights[-1]))


def fit_quality(
    df: DataFrame,
    doc_id: str,
    text: str,
    labels: DataFrame,
    label: str,
    among: Column | None = None,
    bound: int = 8000,
    bits: int = BITS,
) -> np.ndarray:
    """Weights from at most ``bound`` labelled documents.

    ``among`` (over ``doc_id``) says which labels may be learned from. Of several
    documents of one id one counts. Without labels all weights are 0.
    """
    sample = sampled_labels(labels, doc_id, label, bound, among)
    sample = F.broadcast(sample.withColumnRenamed("doc_id", "__id"))  # bounded
    known = df.select(column(doc_id).alias("__of"), column(text).cast("string").alias("__text"))
    joined = known.join(sample, F.col("__of") == F.col("__id"))

    def batch(texts: list[str | None]) -> dict[str, list[bytes]]:
        found = [features(t, bits) for t in texts]
        return {
            "places": [p.astype("<i4").tobytes() for p, _ in found],
            "values": [v.astype("<f4").tobytes() for _, v in found],
        }

    made = text_column(F.col("__text"), "places binary, values binary", batch)
    vectors = joined.select("__id", "label", made.alias("v"))
    one = vectors.groupBy("__id").agg(F.min(F.struct("label", "v")).alias("s"))
    rows = one.orderBy(F.xxhash64("__id"), "__id").select("s.label", "s.v.*").collect()
    examples = [
        (np.frombuffer(r["places"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows
    ]
    targets = np.array([float(r["label"]) for r in rows])
    return ftrl.train(examples, targets, 1 << bits, alpha=0.5, l1=0.05, l2=0.0)


def score_quality(df: DataFrame, text: str, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher is better).

    A NULL or empty text has the score of the intercept. A column ``score`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)  # 2**bits numbers

    def batch(texts: list[str | None]) -> list[float]:
        return [score(t, shared.value, bits) for t in texts]

    given = without(df, "score")
    return given.withColumn("score", text_column(column(text), "double", batch))
