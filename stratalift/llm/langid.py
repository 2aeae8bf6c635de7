"""Language identification by rank-order profiles.

A language's profile ranks the letter n-grams of its documents by frequency. A
document is ranked the same way and goes to the language whose ranks are least
out of place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalift.llm.frames import column, free_name, text_column, without

SPACE = 32
SHIFT = np.uint64(21)  # bits of a code point
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Every code point if it is a letter, else a space."""
    return np.array([c if chr(c).isalpha() else SPACE for c in range(0x110000)], np.uint32)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to three letters within words, as numbers, and their counts.

    Words are lower-cased runs of letters; a space stands at both of their ends.
    """
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    marks = _letters()[np.frombuffer(raw, "<u4")]
    marks = np.concatenate([[SPACE], marks, [SPACE]])
    spaces = marks == SPACE
    marks = marks[~(spaces & np.concatenate([[False], spaces[:-1]]))].astype(np.uint64)
    if len(marks) < 2:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    spaces = marks == SPACE
    pairs = marks[:-1] | marks[1:] << SHIFT
    threes = pairs[:-1] | marks[2:] << (SHIFT + SHIFT)
    grams = np.concatenate([marks[~spaces], pairs, threes[~spaces[1:-1]]])
    return np.unique(grams, return_counts=True)


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # gram, language; the last row is for grams of no profile
    length: int  # a gram that a profile lacks is this far out of place

    def nearest(self, text: str | None, document_length: int) -> tuple[str, float]:
        """The language, and 1 less its share of the largest distance there could be."""
        grams, counts = ngrams(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        first = np.argsort(-counts, kind="stable")[:document_length]
        own = _ranks(counts[first])
        at = np.searchsorted(self.grams, grams[first])
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == grams[first], at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.length, np.minimum(abs(ranks - own[:, None]), self.length))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return self.languages[best], float(1 - total[best] / (self.length * len(own)))


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Ranks of descending counts; equal counts share the mean of their ranks."""
    starts = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(counts)]]))
    return np.repeat(starts + (sizes - 1) / 2, sizes)


def fit_profiles(
    df: DataFrame,
    doc_id: str,
    text: str,
    language: str,
    among: Column | None = None,
    per_language: int = 2000,
    length: int = 600,
) -> Profiles:
    """Profiles of ``length`` n-grams from at most ``per_language`` documents of each language.

    Those with the lowest hashes of the id are taken. Rows without language or
    id, and those for which ``among`` does not hold, teach nothing; NULL and empty texts
    add no n-gram. Repeated rows of an id are drawn each and count each. N-grams of equal number are in
    the order of their codes. A language without n-grams has no profile.
    """
    known = df.select(
        column(doc_id).alias("__id"),
        column(language).cast("string").alias("__language"),
        column(text).cast("string").alias("__text"),
        (F.lit(True) if among is None else among).alias("__among"),
    ).where("__among AND __id IS NOT NULL AND __language IS NOT NULL")
    order = Window.partitionBy("__language").orderBy(F.xxhash64("__id"), "__id")
    chosen = (
        known.groupBy("__id", "__language")
        .agg(F.count(F.lit(1)))
        .withColumn("__n", F.row_number().over(order))
        .where(F.col("__n") <= per_language)
        .select("__id", F.col("__language").alias("__of"))
    )
    # per_language rows of each language: bounded
    chosen = F.broadcast(chosen.withColumnRenamed("__id", "__other"))
    same = (F.col("__id") == F.col("__other")) & (F.col("__language") == F.col("__of"))
    texts = known.join(chosen, same)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, part in frame.groupby("__language"):
                found = [ngrams(t) for t in part["__text"] if isinstance(t, str)]
                if found:
                    grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([c for _, c in found]))
                    yield pd.DataFrame(
                        {"language": name, "gram": grams.astype(np.int64), "n": n.astype(np.int64)}
                    )

    counted = texts.select("__language", "__text").mapInPandas(
        count, "language string, gram long, n long"
    )
    top = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    ranked = (
        counted.groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(top))
        .where(F.col("rank") <= length)
    )
    rows = ranked.select("language", "gram", "rank").collect()  # length rows of each language
    languages = sorted({r["language"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), np.uint64)
    ranks = np.full((len(grams) + 1, len(languages)), -1.0)
    place = {g: k for k, g in enumerate(grams.tolist())}
    for r in rows:
        ranks[place[r["gram"]], languages.index(r["language"])] = r["rank"] - 1
    return Profiles(languages, grams, ranks, length)


def identify(
    df: DataFrame, text: str, profiles: Profiles, document_length: int = 400
) -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` (0 to 1) of their whole texts.

    A NULL text, and one without letters, is ``und`` with score 0, as is every
    text where there are no profiles. Of languages as near as each other the first by name counts, and
    a text's n-grams of equal number share the mean of their ranks, so repeated rows have the same
    result. Texts are read whole, however long. Columns of these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    def batch(texts: list[str | None]) -> dict[str, list]:
        found = [shared.value.nearest(t, document_length) for t in texts]
        return {"lang_pred": [f for f, _ in found], "score": [s for _, s in found]}

    given = without(df, "lang_pred", "score")
    named = text_column(column(text), "lang_pred string, score double", batch)
    own = free_name(given, "__named")
    return given.withColumn(own, named).select(
        *[column(c) for c in given.columns], f"{own}.lang_pred", f"{own}.score"
    )
