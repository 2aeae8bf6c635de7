"""Toxicity by weak supervision.

Lexicon and pattern voters label documents, a generative model turns their votes
into probabilities, and a linear classifier over hashed words and word starts
learns these probabilities. Only the classifier scores documents, so it also
covers words no voter knows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.llm import ftrl
from stratalift.llm.frames import column, free_name, sampled_labels, text_column, without
from stratalift.llm.labelmodel import LabelModel, fit_label_model

BITS = 20
CACHED_WORDS = 200_000
L1_PER_DOCUMENT, LEAST_L1 = 0.00125, 3.0
BOOST, UPDATES = 4.0, 40_000
STARTS = range(5, 9)  # lengths of word starts
WORD = re.compile(r"[^\W_]+")
# Insults and contempt of common use, by language. Everyday words that also insult are left out:
# the mined lexicons find them where they mark toxic documents.
LEXICONS = {
    "en": "idiot idiots idiotic moron morons moronic stupid stupidity loser losers scum scumbag pathetic "
    "worthless disgusting imbecile imbeciles dumbass dumb bastard bastards bitch bitches asshole "
    "assholes fuck fucking fucker shit shitty retard retarded vermin dickhead jackass cretin halfwit",
    "de": "idiot idioten idiotin dummkopf arschloch arschlöcher scheiße scheisse beschissen abschaum "
    "versager trottel drecksau wichser hurensohn missgeburt schlampe widerlich schwachkopf vollidiot "
    "depp deppen fresse verpiss",
    "fr": "idiot idiote imbécile connard connards connasse salaud salauds salope merde crétin crétine débile "
    "abruti abrutis enculé pathétique dégoûtant bouffon minable pourriture ducon conne",
    "es": "idiota idiotas imbécil imbéciles estúpido estúpida cabrón cabrones gilipollas puta mierda escoria "
    "patético patética asqueroso asquerosa inútil pendejo maldito subnormal",
}
# Word starts that inflected and compound insults share.
STEMS = tuple(
    "idiot moron scumb dumba asshol fuck shit retard arschl scheiß scheiss vollidi wichs huren connar "
    "salop encul crétin imbéci gilip cabron estúpid".split()
)
LEXICON_SETS = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
KNOWN = frozenset().union(*LEXICON_SETS.values())
OBFUSCATED = str.maketrans("013457@$!", "oieastasi")
LEET = re.compile(r"[^\W_]*[^\W\d_][013457@$]+[^\W\d_][^\W_]*")
IN_WORD = re.compile(r"[013457@$](?<=[^\W\d_].)")  # what LEET needs, found faster
SPELLED = re.compile(r"(?<!\w)\w(?:[ .*_-]\w){3,}(?!\w)")
APART = re.compile(r"[ .*_-]")


def hidden_words(text: str) -> set[str]:
    """What words with digits for letters, or letters set apart, stand for; ``text`` in lower case."""
    leet = {w.translate(OBFUSCATED) for w in LEET.findall(text)} if IN_WORD.search(text) else set()
    return leet | {APART.sub("", w) for w in SPELLED.findall(text)}


def words_of(text: str | None) -> set[str]:
    """The distinct words in lower case, and those that are only hidden."""
    lower = (text or "").lower()
    return set(WORD.findall(lower)) | hidden_words(lower)


def word_parts(word: str) -> list[str]:
    """The word and its starts."""
    return [word, *(f"{word[:n]}*" for n in STARTS if len(word) > n)]


class Voters:
    """Lexicons by language, lexicons mined from labelled documents, and patterns.

    Mined words go to ``groups`` voters by turns, so that each votes on its own evidence.
    """

    def __init__(self, mined: Sequence[str] = (), groups: int = 4) -> None:
        self.lexicons = list(LEXICON_SETS.values())
        self.mined = [set(mined[k::groups]) for k in range(groups)] if mined else []
        self.known = set().union(*self.lexicons, *self.mined)

    def vote(self, words: set[str], hidden: set[str]) -> list[int]:
        """1 (toxic), -1 or 0 (nothing) of each voter."""
        parts = {p for w in words for p in word_parts(w)} if self.mined else words
        lexicons = [int(bool(words & lexicon)) for lexicon in self.lexicons]
        mined = [int(bool(parts & lexicon)) for lexicon in self.mined]
        hits = len(parts & self.known)
        stems = any(w.startswith(STEMS) for w in words)
        patterns = [int(hits >= 2), int(hits >= 3), int(bool(hidden & self.known)), int(stems), 0 if hits else -1]
        return lexicons + mined + patterns


def mine_words(
    texts: Sequence[set[str]], toxic: Sequence[int], most: int = 400, least: int = 5
) -> list[str]:
    """Words and word starts that mark toxic documents, the surest first.

    At least ``least`` toxic documents must hold one, seven tenths of all that hold it must be
    toxic, and the log-likelihood ratio against chance must exceed the logarithm of how many
    are tried by two, so that what a few toxic documents happen to share is not taken for a
    mark, however many or few documents there are.
    """
    hit, miss = Counter(), Counter()
    for words, label in zip(texts, toxic, strict=True):
        if label:
            hit.update({p for w in words for p in word_parts(w)})
    rate = sum(map(bool, toxic)) / max(1, len(toxic))
    tried = [(part, n) for part, n in hit.items() if n >= least]
    wanted = {part for part, _ in tried}
    for words, label in zip(texts, toxic, strict=True):
        if not label:
            miss.update({p for w in words for p in word_parts(w)} & wanted)
    found = []
    for part, n in tried:
        m = miss[part]
        if n < 0.7 * (n + m):
            continue
        expected = (n + m) * rate
        ratio = n * math.log(n / expected) + (m * math.log(m / (n + m - expected)) if m else 0)
        if n > expected and ratio > math.log(len(tried)) + 2:
            found.append((-ratio, part))
    return [part for _, part in sorted(found)[:most]]


def places_of(word: str, bits: int = BITS) -> list[int]:
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) >> (32 - bits) for p in word_parts(word)]


def lexicon_places(words: set[str], bits: int = BITS) -> list[int]:
    """Places for the lexicons that have some of the words, and for how many of these they are."""
    known = words & KNOWN
    if not known:
        return []
    names = [f"#{name}" for name, lexicon in LEXICON_SETS.items() if known & lexicon]
    names += [f"#{n}" for n in (1, 2, 3) if len(known) >= n]
    return [zlib.crc32(n.encode()) >> (32 - bits) for n in names]


def features(words: set[str], bits: int = BITS) -> ftrl.Example:
    """Places of the distinct words and their starts, with the number of words at each, and of
    the lexicons."""
    found = [place for word in words for place in places_of(word, bits)]
    places, counts = np.unique(np.array(found + lexicon_places(words, bits), np.int64), return_counts=True)
    return places, counts.astype(float)


class Scorer(dict):
    """The dot product of a text and the weights, from the part of each distinct word."""

    def __init__(self, weights: np.ndarray, bits: int = BITS) -> None:
        self.weights, self.bits = weights, bits

    def __missing__(self, word: str) -> float:
        value = float(self.weights[places_of(word, self.bits)].sum())
        self[word] = value
        return value

    def score(self, text: str | None) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        words = words_of(text)
        total = math.fsum(map(self.__getitem__, words))
        total += math.fsum(self.weights[lexicon_places(words, self.bits)])
        return float(ftrl.sigmoid(total + self.weights[-1]))


def fit_toxicity(
    df: DataFrame,
    doc_id: str,
    text: str,
    labels: DataFrame,
    label: str,
    among: Column | None = None,
    bound: int = 8000,
    bits: int = BITS,
) -> tuple[np.ndarray, LabelModel]:
    """The classifier's weights and the label model, from at most ``bound`` labelled documents.

    ``among`` (over ``doc_id``) says which labels may be learned from. The given
    label is one more voter. Of several documents of one id one counts. Without
    labels nothing is mined and every score is the intercept's.
    """
    sample = sampled_labels(labels, doc_id, label, bound, among)
    sample = F.broadcast(sample.withColumnRenamed("doc_id", "__id"))  # bounded
    given = df.select(column(doc_id).alias("__of"), column(text).cast("string").alias("__text"))
    joined = given.join(sample, F.col("__of") == F.col("__id"))

    def batch(texts: list[str | None]) -> dict[str, list[str]]:
        hidden = [hidden_words((t or "").lower()) for t in texts]
        return {
            "words": ["\n".join(sorted(words_of(t))) for t in texts],
            "hidden": ["\n".join(sorted(h)) for h in hidden],
        }

    made = text_column(F.col("__text"), "words string, hidden string", batch)
    rows = joined.select("__id", "label", made.alias("w"))
    one = rows.groupBy("__id").agg(F.min(F.struct("label", "w")).alias("s"))
    ordered = one.orderBy(F.xxhash64("__id"), "__id").select("s.label", "s.w.*")
    known = ordered.collect()
    texts, hidden = (WordSets([r[name] for r in known]) for name in ("words", "hidden"))
    given = np.array([int(r["label"]) for r in known], np.int64)
    return fit_words(texts, hidden, given, bits)


class WordSets(Sequence):
    """Sets of words, kept as texts of a word a line: thousands of sets take ten times the memory."""

    def __init__(self, lines: list[str]) -> None:
        self.lines = lines

    def __len__(self) -> int:
        return len(self.lines)

    def __getitem__(self, at: int) -> set[str]:
        return set(self.lines[at].split("\n")) - {""}


def fit_words(
    texts: Sequence[set[str]], hidden: Sequence[set[str]], given: np.ndarray, bits: int = BITS
) -> tuple[np.ndarray, LabelModel]:
    """The classifier's weights and the label model, from documents as sets of words."""
    voters = Voters(mine_words(texts, given))
    cast = [
        [*voters.vote(t, h), 1 if y else -1] for t, h, y in zip(texts, hidden, given, strict=True)
    ]
    votes = np.array(cast, np.int64).reshape(len(texts), len(voters.vote(set(), set())) + 1)
    model = fit_label_model(votes, given=-1)
    return train_classifier(texts, model.posterior(votes), voters.known, bits), model


def train_classifier(
    texts: Sequence[set[str]], beliefs: np.ndarray, marks: set[str], bits: int = BITS
) -> np.ndarray:
    """The weights of places. Those of the marks (words and starts) and of the lexicons are learned
    faster, as a few documents are enough to trust them."""
    boost = np.ones((1 << bits) + 1)
    boost[[zlib.crc32(m.encode("utf-8", "surrogatepass")) >> (32 - bits) for m in sorted(marks)]] = BOOST
    boost[lexicon_places(set(KNOWN), bits)] = BOOST
    examples = []
    for text in texts:
        places, values = features(text, bits)
        examples.append((places.astype(np.int32), (values * boost[places]).astype(np.float32)))
    # sums of gradients grow with the documents, and so does the bound they must exceed
    l1 = max(LEAST_L1, L1_PER_DOCUMENT * len(examples))
    rounds = max(5, min(40, UPDATES // max(1, len(examples))))
    weights = ftrl.train(examples, beliefs, 1 << bits, alpha=1.0, l1=l1, l2=0.0, rounds=rounds)
    return weights * boost


def score_toxicity(df: DataFrame, text: str, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher is more toxic) over their whole texts.

    A NULL or empty text has the score of the intercept. A column ``score`` is replaced.
    """
    scorer = score_column(df, text, weights, bits)
    return without(df, "score").withColumn("score", scorer)


def score_column(df: DataFrame, text: str, weights: np.ndarray, bits: int = BITS) -> Column:
    # 2**bits numbers; a worker keeps the scorer, and so the words it has met, between batches
    shared = df.sparkSession.sparkContext.broadcast(Scorer(weights, bits))

    def batch(texts: list[str | None]) -> list[float]:
        return list(map(shared.value.score, texts))

    return text_column(column(text), "double", batch)


def drop_toxic(df: DataFrame, text: str, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with their own columns.

    A NULL or empty text scores as the intercept says, which is low unless most labels are toxic.
    """
    scorer = score_column(df, text, weights)
    own = free_name(df, "__toxic")
    scored = df.withColumn(own, scorer).where(F.col(own) < threshold)
    return scored.select(*[column(c) for c in df.columns])
