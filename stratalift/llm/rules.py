"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule starts empty and grows by the threshold that gains
most information on two thirds of the labelled rows, then loses those last
conditions without which it does better on the other third; the rows it covers
are put aside and the next rule is grown from the rest. The list comes out as
one ordered Spark conditional expression over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.llm.frames import column, free_name, sampled_labels, text_column
from stratalift.staging import stage_rows

SYMBOLS = "#*$%&|<>"
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
WINDOW = 5
STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_distinct long, n_capitals long, n_letters long, n_marks long"
)
# What rules compare: one statistic over another, 0 where the latter is 0.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "distinct_share": ("n_distinct", "n_words"),
    "capital_share": ("n_capitals", "n_letters"),
    "mark_share": ("n_marks", "word_chars"),
    "word_length": ("word_chars", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        found = values[self.ratio]
        return found > self.threshold if self.above else found <= self.threshold

    def column(self, inside: str = "") -> Column:
        found = ratio_column(self.ratio, inside)
        return found > self.threshold if self.above else found <= self.threshold

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice."""
    grams = list(zip(*(words[k:] for k in range(window)), strict=False))
    first: dict[tuple, int] = {}
    if len(set(grams)) == len(grams):
        return 0
    twice = np.zeros(len(words) + 1, np.int64)
    for at, gram in enumerate(grams):
        seen = first.setdefault(gram, at)
        if seen != at:
            for start in (seen, at):
                twice[start] += 1
                twice[start + window] -= 1
    return int((np.cumsum(twice) > 0).sum())


def text_statistics(texts: list[str | None]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {f.split()[0]: [] for f in STATISTICS.split(", ")}
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()  # of bytes: splits at space and 9 to 13 alone
        lines = [line for line in raw.split(b"\n") if line.strip()]
        white = len(raw) - sum(map(len, words))
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text or "") - white)
        out["n_symbols"].append(sum(raw.count(s.encode()) for s in SYMBOLS))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(repeated_words(words))
        out["n_lines"].append(len(lines))
        out["n_distinct"].append(len(set(words)))
        for name, chars in (("capitals", CAPITALS), ("letters", LETTERS), ("marks", MARKS)):
            out[f"n_{name}"].append(len(raw) - len(raw.translate(None, chars)))
    return out


def statistics_of(text: Column) -> Column:
    return text_column(text, STATISTICS, text_statistics)


def base_failed(inside: str = "") -> Column:
    repeated, words = F.col(f"{inside}n_repeat_words"), F.col(f"{inside}n_words")
    return (words < 10) | (100 * repeated > 20 * words)


def ratio_column(name: str, inside: str = "") -> Column:
    top, bottom = (F.col(inside + n) for n in RATIOS[name])
    share = top.cast("double") / F.nullif(bottom, F.lit(0)).cast("double")
    return F.coalesce(share, F.lit(0.0))


def rule_column(rules: Sequence[Rule], inside: str = "") -> Column:
    """The number (from 1) of the first rule that holds, NULL where none does."""
    chosen = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(inside)
        chosen = F.when(holds, F.lit(number)).otherwise(chosen)
    return chosen


def learn_rules(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    min_cover: int = 5,
    min_precision: float = 0.9,
    max_conditions: int = 4,
    max_rules: int = 12,
) -> list[Rule]:
    """Rules for the bad rows. A rule must be right for ``min_precision`` of the rows it
    takes and take ``min_cover`` of them; without such rules the list is empty."""
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    cuts = {name: _cuts(found) for name, found in values.items()}
    rules: list[Rule] = []
    while len(rules) < max_rules and (left & bad).sum() >= min_cover:
        rule = _grow(values, bad, left & ~third, cuts, max_conditions)
        rule = _prune(values, bad, left & third, rule)
        taken = left & _covers(values, rule)
        if not rule or (taken & bad).sum() < max(min_cover, min_precision * taken.sum()):
            break
        rules.append(rule)
        left &= ~taken
    return rules


def _cuts(found: np.ndarray, most: int = 100) -> np.ndarray:
    """Midpoints between neighbouring quantiles."""
    marks = np.unique(np.quantile(found, np.linspace(0, 1, most))) if len(found) else found
    return (marks[1:] + marks[:-1]) / 2


def _covers(values: dict[str, np.ndarray], rule: Rule) -> np.ndarray:
    out = np.ones(len(next(iter(values.values()))), bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _grow(values, bad, rows, cuts, max_conditions: int) -> Rule:
    rule: Rule = ()
    covered = rows
    while len(rule) < max_conditions:
        p0, n0 = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for name, found in values.items():
            hits, misses = np.sort(found[covered & bad]), np.sort(found[covered & ~bad])
            p_low = np.searchsorted(hits, cuts[name], "right")
            n_low = np.searchsorted(misses, cuts[name], "right")
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                gain = np.where(p > 0, gain, -1.0)
                if len(gain) and gain.max() > best_gain:
                    at = int(gain.argmax())
                    best = Condition(name, above, float(cuts[name][at]))
                    best_gain = float(gain[at])
        if best is None:
            break
        rule = (*rule, best)
        covered = covered & best.holds(values)
    return rule


def _prune(values, bad, rows, rule: Rule) -> Rule:
    """The shortest start of the rule with the best (right - wrong) / covered."""

    def worth(start: Rule) -> float:
        taken = rows & _covers(values, start)
        right = int((taken & bad).sum())
        return (2 * right - int(taken.sum())) / max(1, int(taken.sum()))

    starts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(starts, key=lambda r: (worth(r), -len(r)), default=())


def ratios(frame) -> dict[str, np.ndarray]:
    out = {}
    for name, (top, bottom) in RATIOS.items():
        over = frame[bottom].to_numpy(float)
        share = frame[top].to_numpy(float) / np.where(over == 0, 1, over)
        out[name] = np.where(over == 0, 0.0, share)
    return out


def fit_rules(
    statistics: DataFrame, doc_id: str, labels: DataFrame, label: str, bound: int = 20_000
) -> list[Rule]:
    """Rules from the statistics of at most ``bound`` labelled documents (label 0: bad).

    Documents that fail the base rules are left out, as are NULL ids and labels.
    Of several documents of one id one counts. Without both labels: no rules.
    """
    sample = sampled_labels(labels, doc_id, label, bound)  # bounded, so it may be broadcast
    known = statistics.where(~base_failed()).join(
        F.broadcast(sample.withColumnRenamed("doc_id", "__id")), column(doc_id) == F.col("__id")
    )
    names = sorted({n for pair in RATIOS.values() for n in pair})
    one = known.groupBy("__id").agg(F.min(F.struct("label", *names)).alias("s"))
    frame = one.orderBy(F.xxhash64("__id"), "__id").select("s.*").toPandas()
    return learn_rules(ratios(frame), frame["label"].to_numpy() == 0)


def quality_rules(
    df: DataFrame, doc_id: str, text: str, labels: DataFrame, label: str, bound: int = 20_000
) -> DataFrame:
    """Per row of ``df``: the id, its statistics, ``base_failed``, ``rule`` and ``kept``.

    A NULL or empty text has no words, fails the base rules and is not kept.
    Repeated rows and NULL ids are rows like others. Other columns are left out.
    """
    found = df.select(column(doc_id), statistics_of(column(text)).alias("__s"))
    statistics = stage_rows(found.select(column(doc_id), "__s.*"), "statistics")
    rules = fit_rules(statistics, doc_id, labels, label, bound)
    judged = statistics.withColumn("base_failed", base_failed()).withColumn(
        "rule", rule_column(rules)
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(
    df: DataFrame, doc_id: str, text: str, labels: DataFrame, label: str, bound: int = 20_000
) -> DataFrame:
    """The rows of ``df`` that ``quality_rules`` keeps, with their own columns.

    A NULL or empty text fails the base rules and goes; rows with a NULL id are judged like others.
    """
    ids = sampled_labels(labels, doc_id, label, bound)
    labelled = df.join(F.broadcast(ids), df[doc_id] == ids["doc_id"], "left_semi")
    found = labelled.select(column(doc_id), statistics_of(column(text)).alias("__s"))
    rules = fit_rules(found.select(column(doc_id), "__s.*"), doc_id, labels, label, bound)
    own = free_name(df, "__s")
    judged = df.withColumn(own, statistics_of(column(text)))
    inside = f"{own}."
    good = ~base_failed(inside) & rule_column(rules, inside).isNull()
    return judged.where(good).select(*[column(c) for c in df.columns])
