"""Benchmark decontamination: BM25 with block-max WAND, then overlap.

The test items are the documents of an inverted index and every passage of
every training text is a query. An item is retrieved if its BM25 score reaches
a bound of its own: what it would score by all its words, less the most that
the words of a fifth of its shingles can weigh. A passage that holds four fifths
of an item's five-word shingles, or of those of its question and of those of its
answer, therefore always retrieves it. Retrieved items are compared shingle by
shingle, whole and with question and answer apart.

Weights are divided by the item's bound, so that one threshold, 1, holds for all.
Upper bounds let nearly all work be skipped: lists that together cannot reach 1
make no candidates, blocks of items are scored only if the sum of their block
maxima reaches 1, and what a stretch of text cannot reach none of its passages can.

Passages are long against their stride: an item is sure to be found, wherever it
stands, if what of it the text holds lies within ``Index.sure`` words. These are
more than twice its own words, and 32 more at least, so other text may stand
between its parts. What is spread over more, up to a whole passage, is found or
not by its place.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.llm.frames import bound_batches, column, text_column

WORD = re.compile(r"\w+")
SHINGLE = 5
OVERLAP = 0.8
BLOCK_ITEMS = 8
K1, B = 1.2, 0.75
LEAST_WINDOW = 64
# Strides of a passage; items have at most a third of its words.
STRIDES = 6
INDEX_BYTES = 32_000_000
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: Sequence[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    size = min(SHINGLE, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line or sentence of an item is its answer; a single one is all question."""
    parts = [p for p in SENTENCE_END.split(text.strip()) if WORD.search(p)]
    if len(parts) < 2:
        return text, ""
    at = text.rindex(parts[-1])
    return text[:at], text[at:]


@dataclass(frozen=True)
class Item:
    item_id: int | None
    whole: frozenset
    question: frozenset
    answer: frozenset

    def overlap(self, held: set) -> tuple[float, float, float | None]:
        """The shares of the item's, the question's and the answer's shingles that are held."""
        shares = [len(p & held) / len(p) if p else None for p in (self.whole, self.question, self.answer)]
        return shares[0], shares[1] if shares[1] is not None else shares[0], shares[2]

    @property
    def in_parts(self) -> bool:
        """Whether question and answer may stand apart; fewer words than a shingle may not."""
        return bool(self.question and self.answer) and all(len(s) == SHINGLE for s in self.whole)

    def missing(self) -> int:
        """The most shingles, and so words, that a passage that holds the item can lack."""

        def fifth(part: frozenset) -> int:
            return math.floor((1 - OVERLAP) * len(part) + 1e-9)

        apart = fifth(self.question) + fifth(self.answer) if self.in_parts else 0
        return max(fifth(self.whole), apart)

    def is_held(self, shares: tuple[float, float, float | None]) -> bool:
        """By the whole item, or by question and answer, whatever stands between them."""
        if shares[0] >= OVERLAP:
            return True
        return self.in_parts and min(shares[1:]) >= OVERLAP


class _Vocabulary(dict):
    def __missing__(self, word: str) -> int:
        return -1  # not kept: the words of the items alone are


class Lists:
    """Lists of (place, weight), one after the other."""

    def __init__(self, lists: list[list[tuple[int, float]]]) -> None:
        self.size = np.array([len(found) for found in lists], np.int64)
        self.start = np.cumsum(self.size) - self.size
        flat = [pair for found in lists for pair in found]
        self.place = np.array([p for p, _ in flat], np.int64)
        self.weight = np.array([w for _, w in flat], float)

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[terms]
        first = np.repeat(self.start[terms] - np.cumsum(size) + size, size)
        at = first + np.arange(len(first))
        return self.place[at], self.weight[at]


class Index:
    """The inverted index of items of at most ``window / 3`` words."""

    def __init__(self, items: list[tuple[int | None, str]], window: int) -> None:
        self.window, self.step = window, window // STRIDES
        # every stretch of so many words lies in one passage
        self.sure = window - self.step + 1
        bags = [words_of(text) for _, text in items]
        self.items = []
        for (item_id, text), words in zip(items, bags, strict=True):
            question, answer = (words_of(p) for p in question_and_answer(text))
            self.items.append(
                Item(item_id, *(frozenset(shingles(w)) for w in (words, question, answer)))
            )
        counts = [Counter(words) for words in bags]
        spread = Counter(word for bag in counts for word in bag)
        mean = sum(map(len, bags)) / max(1, len(bags))
        self.vocabulary = _Vocabulary({word: k for k, word in enumerate(sorted(spread))})
        idf = {w: math.log(1 + (len(bags) - n + 0.5) / (n + 0.5)) for w, n in spread.items()}
        lists: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        self.bounds = []
        for at, (bag, words) in enumerate(zip(counts, bags, strict=True)):
            damp = K1 * (1 - B + B * len(words) / mean)
            weights = {w: idf[w] * n * (K1 + 1) / (n + damp) for w, n in bag.items()}
            heaviest = sorted(weights.values(), reverse=True)[: self.items[at].missing()]
            bound = max(sum(weights.values()) - sum(heaviest), 1e-9) * (1 - 1e-9)
            self.bounds.append(bound)
            for word, weight in weights.items():
                lists[self.vocabulary[word]].append((at, weight / bound))
        blocks = []
        for found in lists:
            most: dict[int, float] = {}
            for at, weight in found:
                most[at // BLOCK_ITEMS] = max(weight, most.get(at // BLOCK_ITEMS, 0.0))
            blocks.append(sorted(most.items()))
        self.postings, self.blocks = Lists(lists), Lists(blocks)
        self.most = np.array([max((w for _, w in found), default=0.0) for found in lists])
        self.n_blocks = -(-len(items) // BLOCK_ITEMS)

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Items (places) whose score by these distinct terms reaches their bound, with it."""
        most = self.most[terms]
        order = np.argsort(most)
        reach = np.cumsum(most[order])
        if not len(reach) or reach[-1] < 1:
            return []
        # the lists before cannot reach the threshold by themselves
        essential = terms[order[np.searchsorted(reach, 1.0) :]]
        candidate = np.zeros(self.n_blocks, bool)
        candidate[self.blocks.of(essential)[0]] = True
        place, weight = self.blocks.of(terms)
        upper = np.bincount(place, weight, self.n_blocks)
        candidate &= upper >= 1
        if not candidate.any():
            return []
        place, weight = self.postings.of(terms)
        inside = candidate[place // BLOCK_ITEMS]
        score = np.bincount(place[inside], weight[inside], len(self.items))
        return [(int(k), float(score[k])) for k in np.flatnonzero(score >= 1)]

    def matches(self, words: list[str]) -> dict[int, tuple[float, float, float, float | None]]:
        """Score and overlaps of every item that a passage of the words holds."""
        terms = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
        step = self.step
        out: dict[int, tuple] = {}
        # stretches of passages: numbers of the first and of the one after the last
        stack = [(0, max(1, 1 - (self.window - len(words)) // step))]
        while stack:
            first, last = stack.pop()
            begin, end = first * step, (last - 1) * step + self.window
            known = np.unique(terms[begin:end])
            found = self.retrieve(known[known >= 0])
            if found and last - first > 1:
                middle = (first + last) // 2
                stack += [(first, middle), (middle, last)]
            elif found:
                held = shingles(words[begin:end]) if len(words) >= SHINGLE else set()
                for at, score in found:
                    item = self.items[at]
                    own = held
                    if any(len(s) < SHINGLE for s in item.whole | item.answer | item.question):
                        own = held | _short(words[begin:end])
                    shares = item.overlap(own)
                    if item.is_held(shares) and shares > out.get(at, (0, -1.0))[1:]:
                        out[at] = (score * self.bounds[at], *shares)
        return out


def _short(words: list[str]) -> set:
    """Sequences of fewer words than a shingle, for items or answers that are so short."""
    return {tuple(words[k : k + n]) for n in range(1, SHINGLE) for k in range(len(words) - n + 1)}


def build_indexes(items: Sequence[tuple[int | None, str | None]]) -> list[Index]:
    """An index for each power of two of words; items without words are in none."""
    by_window: dict[int, list[tuple[int | None, str]]] = {}
    for item_id, text in items:
        if n := len(words_of(text)):
            most = max(LEAST_WINDOW, 1 << (n - 1).bit_length())
            by_window.setdefault(3 * most, []).append((item_id, text))
    return [Index(found, window) for window, found in sorted(by_window.items())]


def _chunks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[Index]]:
    """The indexes of all items, as many of about ``INDEX_BYTES`` as it takes."""
    items = benchmark.select(
        column(item_id).alias("item_id"), column(text).cast("string").alias("text")
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, math.ceil(total / INDEX_BYTES))
    dealt = items.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)))
    for chunk in range(chunks):
        rows = dealt.where(F.col("chunk") == chunk).orderBy("item_id", "text").collect()
        yield build_indexes([(r["item_id"], r["text"]) for r in rows])


def contamination(
    df: DataFrame, doc_id: str, text: str, benchmark: DataFrame, item_id: str, item_text: str
) -> DataFrame:
    """A row per document and test item that it holds: ``doc_id``, ``item_id``, the BM25
    ``score`` of the passage, ``overlap``, ``question_overlap`` and ``answer_overlap``.

    An item counts as held if a passage has at least four fifths of its distinct
    five-word shingles, or four fifths of those of its question and four fifths of
    those of its answer, so that a label between them loses nothing (``overlap`` can
    then be less than 0.8; a label inside the question counts against the question).
    An item of fewer words is one shingle, as is a part of fewer. NULL and empty
    texts and items hold and match nothing. Repeated rows give repeated results, and
    ids keep their types, NULL ones stay NULL. Items go round in bounded indexes, each over all documents.
    """
    rows = df.select(
        column(doc_id).alias("doc_id"), column(text).cast("string").alias("text")
    )
    scores = T.StructType.fromDDL(
        "score double, overlap double, question_overlap double, answer_overlap double"
    )
    item = T.StructField("item_id", benchmark.schema[item_id].dataType)
    schema = T.StructType([rows.schema["doc_id"], item, *scores])
    whole = [f.name for f in schema[:2] if isinstance(f.dataType, T.IntegralType)]
    bound_batches(df.sparkSession)
    out = None
    for indexes in _chunks(benchmark, item_id, item_text):
        shared = df.sparkSession.sparkContext.broadcast(indexes)

        def search(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names = schema.names
            for frame in frames:
                found = []
                for doc, body in zip(frame["doc_id"], frame["text"], strict=True):
                    words = words_of(body if isinstance(body, str) else None)
                    for index in shared.value:
                        for at, shares in index.matches(words).items():
                            found.append((doc, index.items[at].item_id, *shares))
                yield pd.DataFrame(found, columns=names).astype(
                    dict.fromkeys(whole, "Int64") | dict.fromkeys(names[2:], float)
                )

        part = rows.mapInPandas(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(
    df: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str
) -> DataFrame:
    """The rows of ``df`` that hold no test item, with their own columns.

    NULL and empty texts and items hold nothing; without items all rows are kept.
    """
    for indexes in _chunks(benchmark, item_id, item_text):
        shared = df.sparkSession.sparkContext.broadcast(indexes)

        def holds(texts: list[str | None], shared=shared) -> list[bool]:
            bags = map(words_of, texts)
            return [any(index.matches(words) for index in shared.value) for words in bags]

        df = df.where(~text_column(column(text), "boolean", holds))
    return df
