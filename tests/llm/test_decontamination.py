import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalift.llm import decontamination as dec
from stratalift.llm import queries


def holds(text, item):
    """Brute force: some stretch of two items' length, at any word, has four fifths of the shingles."""
    words, own = dec.words_of(text), dec.words_of(item)
    wanted = dec.shingles(own)
    if not wanted:
        return False
    size = len(next(iter(wanted)))
    length = len(own) + 8
    grams = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
    return any(len(wanted & set(grams[k : k + length])) >= 0.8 * len(wanted) for k in range(max(1, len(grams))))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    sets = {i["item_id"]: dec.shingles(dec.words_of(i["text"])) for i in items}
    wanted = set()
    for d in docs:
        held = dec.shingles(dec.words_of(d["text"]))
        for i in items:
            if len(sets[i["item_id"]] & held) >= 0.8 * len(sets[i["item_id"]]) and holds(d["text"], i["text"]):
                wanted.add((d["doc_id"], i["item_id"]))
    out = queries.QUERIES["op5_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == wanted and len(out) == len(wanted) > 0
    assert all(r["overlap"] >= 0.8 and r["score"] > 0 for r in out)


def test_retrieval_against_all_scores():
    dice = random.Random(2)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(dice.choices(vocabulary, k=dice.randrange(5, 40)))) for k in range(50)]
    index = dec.Index(items, 128)
    for _ in range(300):
        terms = np.unique([index.vocabulary[w] for w in dice.sample(vocabulary, dice.randrange(1, 60))])
        score = np.zeros(50)
        for t in terms:
            place, weight = index.postings.of(np.array([t]))
            score[place] += weight
        wanted = {k for k in range(50) if score[k] >= 1}
        got = dict(index.retrieve(terms))
        assert got.keys() == wanted and all(abs(got[k] - score[k]) < 1e-9 for k in got)


@pytest.mark.parametrize("seed", range(5))
def test_cut_and_changed_items_are_found(seed):
    dice = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(dice.choices(vocabulary, k=dice.randrange(12, 150)))) for k in range(30)]
    indexes = dec.build_indexes(items)
    assert len(indexes) > 1
    for item_id, text in items:
        words = text.split()
        for _ in range(4):
            part = list(words)
            if dice.random() < 0.5:
                part = part[: -dice.randrange(1, max(2, len(part) // 4))]
            else:
                part[dice.randrange(len(part))] = "changed"
            around = dice.choices(vocabulary, k=dice.randrange(600))
            at = dice.randrange(len(around) + 1)
            doc = around[:at] + part + around[at:]
            got = any(index.items[k].item_id == item_id for index in indexes for k in index.matches(doc))
            assert got == holds(" ".join(doc), text)


def test_question_and_answer():
    assert dec.question_and_answer("Who is it? It is me.") == ("Who is it? ", "It is me.")
    assert dec.question_and_answer("One line") == ("One line", "")
    index = dec.Index([(1, "what is the name of the red river\nit is nile")], 128)
    found = index.matches("so what is the name of the red river it is nile".split())
    assert found[0][1:] == (1.0, 1.0, 1.0)


def test_nulls_repeats_short_and_clashes(spark):
    rows = [(1, "A b, c"), (1, "A b, c"), (None, "x a b c y"), (2, None), (3, ""), (4, "z " * 60_000 + "a b c")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("overlap", F.lit("o"))
    items = spark.createDataFrame([(7, "a b c"), (8, None), (9, ""), (None, "no such words")], "item_id int, text string")
    out = dec.contamination(df, "doc_id", "text", items, "item_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in out) == [(0, 7), (1, 7), (1, 7), (4, 7)]
    left = dec.drop_contaminated(df, "text", items, "item_id", "text")
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    assert dec.contamination(df.limit(0), "doc_id", "text", items, "item_id", "text").collect() == []
    assert dec.contamination(df, "doc_id", "text", items.limit(0), "item_id", "text").collect() == []


def test_many_indexes(spark, monkeypatch):
    monkeypatch.setattr(dec, "INDEX_BYTES", 20)
    df = spark.createDataFrame([(1, "a b c d e f and g h i j k l")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (3, "m n o p q")], "item_id int, text string")
    out = dec.contamination(df, "doc_id", "text", items, "item_id", "text").collect()
    assert sorted(r["item_id"] for r in out) == [1, 2]


def holds_in_parts(text, item):
    """Brute force: ``holds``, or such a stretch with four fifths of the question's and of the answer's."""
    words = dec.words_of(text)
    parts = [dec.shingles(dec.words_of(p)) for p in dec.question_and_answer(item)]
    length = len(dec.words_of(item)) + 8

    def share(part, stretch):
        size = len(next(iter(part)))
        return len(part & {tuple(stretch[k : k + size]) for k in range(len(stretch) - size + 1)}) / len(part)

    stretches = (words[k : k + length] for k in range(max(1, len(words) - length + 1)))
    return holds(text, item) or all(parts) and any(all(share(p, s) >= 0.8 for p in parts) for s in stretches)


@pytest.mark.parametrize("label", ["", "Answer:", "The answer is:"])
@pytest.mark.parametrize("around", [0, 30, 61, 100])
def test_a_label_before_the_answer(label, around):
    question, answer = (" ".join(f"{p}{k}" for k in range(n)) for p, n in (("q", 14), ("a", 6)))
    (index,) = dec.build_indexes([(1, f"{question}?\n{answer}.")] + [(k, f"other{k} words of") for k in range(2, 9)])
    text = f"{'x ' * around}{question} {label} {answer}{' y' * around}"
    found = index.matches(dec.words_of(text))
    assert found[0][2:] == (1.0, 1.0)
    assert 0 not in index.matches(dec.words_of(f"{question} {label} another one"))


@pytest.mark.parametrize("seed", range(4))
def test_parts_against_brute_force(seed):
    dice = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)]

    def some(low, high):
        return dice.choices(vocabulary, k=dice.randrange(low, high))

    # a single word would also be found by chance, as passages are longer than the stretches here
    items = [(k, f"{' '.join(some(4, 40))}?\n{' '.join(some(3, 20))}.") for k in range(40)]
    indexes = dec.build_indexes(items)
    seen = set()
    for item_id, text in items:
        for _ in range(4):
            parts = [dec.words_of(p) for p in dec.question_and_answer(text)]
            for part in parts:
                for _ in range(dice.randrange(2)):
                    part[dice.choice((0, -1, dice.randrange(len(part))))] = "changed"
            label = dice.choice(([], ["answer"], ["the", "answer", "is"]))
            doc = some(0, 200) + parts[0] + label + parts[1] + some(0, 200)
            got = any(index.items[k].item_id == item_id for index in indexes for k in index.matches(doc))
            seen.add((got, holds(" ".join(doc), text)))
            assert got == holds_in_parts(" ".join(doc), text)
    assert seen == {(True, True), (True, False), (False, False)}


def test_short_items_stay_one_shingle():
    (index,) = dec.build_indexes([(1, "Where? Here.")])
    assert not index.matches("where is it it is here".split()) and index.matches("so where here it is".split())


@pytest.mark.parametrize("n", [5, 23, 64, 128])
def test_gaps_at_every_alignment(n):
    words = [f"w{k}" for k in range(n)]
    (index,) = dec.build_indexes([(1, " ".join(words))])
    assert index.sure >= 2 * n + 32
    # a gap costs four shingles, so few words may have none
    cut = n // 2 if n > 24 else 0
    for gap in (40, index.sure - n):
        part = words[:cut] + ["filler"] * gap + words[cut:]
        for before in range(2 * index.step):
            for after in (0, 1, index.step, 300):
                assert 0 in index.matches(["x"] * before + part + ["y"] * after), (gap, before, after)
