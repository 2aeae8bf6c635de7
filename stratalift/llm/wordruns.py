"""Runs: stretches of words that repeat with a period, found on a suffix automaton.

The states of a suffix automaton form a tree by their suffix links; the path from the
state of a prefix to the root holds all of its suffixes. Every state has a last
occurrence: where the strings it stands for ended last. A new word gives the whole
path of its prefix the new end, as the access operation of a link-cut tree: the path
falls into few segments of one earlier end each, which become one segment of the
new end. A segment's deepest state says how long the words before its earlier end and before the new
one agree. Where that is at least the distance of both ends, a square ends here; it
reaches back over the agreeing words, and the same square one word later extends it.
Agreement is exact, so a run has the same start at each of its ends, and its last end
makes it whole; the last occurrence is the nearest one, so the period is the smallest.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain, count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.llm.frames import column, text_column, without

# A run is counted from so many words and so many periods on.
LEAST_WORDS, LEAST_PERIODS = 6, 4
LONGEST_GRAM = 4
SLICE_CHARS = 2_000_000


def suffix_links(words: Sequence[int]) -> tuple[array, array, array]:
    """Length and suffix link of every state of the automaton, and the state of every prefix.

    Most states have one transition, which stands in two lists; ``more`` has the others'.
    """
    # arrays, as lists of so many different numbers take ten times the memory
    length, link, word, to = (array("i", [first]) for first in (0, -1, -1, -1))
    more: dict[int, dict[int, int]] = {}
    prefixes = array("i")
    last = 0
    for c in words:
        state = len(length)
        length.append(length[last] + 1)
        link.append(0)
        word.append(-1)
        to.append(-1)
        prefixes.append(state)
        p, last, found = last, state, -1
        while p >= 0:
            known = word[p]
            if known == c:
                found = to[p]
                break
            if known < 0:
                word[p], to[p] = c, state
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {c: state}
                elif c in others:
                    found = others[c]
                    break
                else:
                    others[c] = state
            p = link[p]
        if found < 0:
            continue
        if length[p] + 1 == length[found]:
            link[state] = found
            continue
        clone = len(length)
        length.append(length[p] + 1)
        link.append(link[found])
        word.append(word[found])
        to.append(to[found])
        if found in more:
            more[clone] = more[found].copy()
        link[found] = link[state] = clone
        while p >= 0:
            if word[p] == c:
                if to[p] != found:
                    break
                to[p] = clone
            else:
                others = more.get(p)
                if others is None or others.get(c) != found:
                    break
                others[c] = clone
            p = link[p]
    return length, link, prefixes


class LastOccurrences:
    """Last occurrences of the states, as a link-cut tree over the suffix links.

    A splay tree, ordered by depth, holds the states of one segment; ``up`` is a node's
    parent in it or, for its root, the state above the segment. Only the root's ``end`` counts.
    """

    def __init__(self, length: array, link: array) -> None:
        self.length = length
        # the root of the automaton stands for no words and is left out
        self.up = array("i", (p if p > 0 else -1 for p in link))
        self.above, self.below, self.end = (array("i", [-1]) * len(link) for _ in range(3))

    def access(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """(earlier end, words that agree) of every segment on the way to the root; all of them
        become one of the new end. The iterator has to be used up."""
        up, below, ends = self.up, self.below, self.end
        x, lower = state, -1
        while x >= 0:
            y = up[x]
            if y >= 0 and (self.above[y] == x or below[y] == x):
                self._splay(x)
            if ends[x] >= 0:
                yield ends[x], self.length[x]
            cut = below[x]
            if cut >= 0:
                ends[cut] = ends[x]
            below[x] = lower
            lower, x = x, up[x]
        ends[lower] = end

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its tree."""
        up, above, below = self.up, self.above, self.below
        while True:
            y = up[x]
            if y < 0 or (above[y] != x and below[y] != x):
                return
            z = up[y]
            if z >= 0 and (above[z] == y or below[z] == y):
                self._rotate(y if (above[z] == y) == (above[y] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        """``x`` takes the place of its parent in the tree, and its end where that is the root."""
        up, above, below = self.up, self.above, self.below
        y = up[x]
        z = up[y]
        if above[y] == x:
            moved = above[y] = below[x]
            below[x] = y
        else:
            moved = below[y] = above[x]
            above[x] = y
        if moved >= 0:
            up[moved] = y
        if z >= 0 and above[z] == y:
            above[z] = x
        elif z >= 0 and below[z] == y:
            below[z] = x
        else:
            self.end[x] = self.end[y]
        up[x], up[y] = z, x


def runs_of(
    words: Sequence[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start and period.

    A run is a stretch whose smallest period is ``period``, of at least ``least_words`` and
    ``least_periods`` (2 at least) periods, which neither neighbour extends.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")
    length, link, prefixes = suffix_links(words)
    last = LastOccurrences(length, link)
    ends: dict[tuple[int, int], int] = {}
    for end, state in enumerate(prefixes):
        for earlier, agreeing in last.access(state, end):
            period = end - earlier
            size = period + agreeing
            if size >= least_periods * period and size >= least_words:
                ends[end - size + 1, period] = end
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def near_repeats(
    codes: np.ndarray, texts: np.ndarray, least_words: int, least_periods: int
) -> list[tuple[int, int]]:
    """Stretches (begin, end) outside which no run has a word.

    ``codes`` are the words of all texts one after the other, ``texts`` the text of each.
    All sequences of a few words in a run (so few that two periods and one less fit into any)
    stand in it again, at the distance of its period, which is a ``least_periods``-th of the
    stretch at most. What does not is left out, which shortens stretches and leaves out
    more, until nothing changes.
    """
    room = min(max(least_words, least_periods * q) - 2 * q + 1 for q in range(1, least_words + 1))
    gram = min(LONGEST_GRAM, room)
    n = len(codes) - gram + 1
    if n <= 0:
        return []
    key = codes[:n].astype(np.uint64)
    for k in range(1, gram):  # equal keys of different words only leave more in
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + texts[:n].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    same = (key[order][1:] == key[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    apart = np.where(same, np.diff(order), len(codes))
    near = np.full(n, len(codes))
    near[order[1:]] = apart
    near[order[:-1]] = np.minimum(near[order[:-1]], apart)
    at = np.flatnonzero((near < len(codes)) & (texts[:n] == texts[gram - 1 :]))
    while len(at):
        breaks = np.flatnonzero((np.diff(at) > 1) | (texts[at[1:]] != texts[at[:-1]])) + 1
        first = np.concatenate([[0], breaks])
        sizes = np.diff(np.concatenate([first, [len(at)]]))
        words = np.repeat(sizes + gram - 1, sizes)
        stays = (words >= least_words) & (least_periods * near[at] <= words)
        if stays.all():
            begin = at[first]
            return list(zip(begin.tolist(), (begin + sizes + gram - 1).tolist(), strict=True))
        at = at[stays]
    return []


class Batch:
    """The words of some texts, and their runs."""

    def __init__(self, texts: Sequence[str | None], least_words: int, least_periods: int) -> None:
        # bytes split at ASCII white space alone
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        sizes = np.array([len(w) for w in self.words], np.int64)
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        flat = map(numbers.__getitem__, chain.from_iterable(self.words))
        codes = np.fromiter(flat, np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for begin, end in near_repeats(codes, text, least_words, least_periods):
            own = int(text[begin])
            at = begin - int(first[own])
            found = runs_of(codes[begin:end].tolist(), least_words, least_periods)
            self.runs[own] += [(at + start, length, period) for start, length, period in found]

    def collapsed(self) -> list[str]:
        """The words but those that a run holds after its first period, joined by a space."""
        out = []
        for words, runs in zip(self.words, self.runs, strict=True):
            if runs:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in runs:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                inside = np.cumsum(gone)[:-1] > 0
                words = [w for w, g in zip(words, inside.tolist(), strict=True) if not g]
            out.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return out


def repeat_runs(
    df: DataFrame,
    text: str,
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """The rows with ``runs`` and ``collapsed``, over their whole texts.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` lists
    start, length and smallest period of every run of at least ``least_words`` words and
    ``least_periods`` periods, by start and period; ``collapsed`` is the text without
    the words that any run holds after its first period, joined by single spaces.

    A NULL or empty text has no runs and the empty text. Texts are independent of each
    other, so repeated rows have the same result. Memory grows with the longest text, some
    hundred bytes for each word that repeats nearby, not with the table. Columns of these
    names are replaced, all others are kept.
    """

    def batch(texts: list[str | None]) -> dict[str, list]:
        out: dict[str, list] = {"runs": [], "collapsed": []}
        for some in slices(texts):
            made = Batch(some, least_words, least_periods)
            out["runs"] += [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in made.runs]
            out["collapsed"] += made.collapsed()
        return out

    schema = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    given = without(df, "runs", "collapsed")
    own: Column = text_column(column(text), schema, batch)
    return given.select("*", own.alias("__runs")).select(*[column(c) for c in given.columns], "__runs.*")


def slices(texts: Sequence[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    part: list[str | None] = []
    held = 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


def longest_run(runs: Column) -> Column:
    """The run of the greatest length; of equal ones that of the smallest start, then period."""
    ranked = F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    )
    return F.struct(ranked["start"].alias("start"), (-ranked["less"]).alias("length"), ranked["period"].alias("period"))
