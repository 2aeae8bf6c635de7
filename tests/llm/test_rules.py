import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalift.llm import queries, rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é#|\n\t\x85\xa0\x1c<Z!"), max_size=60))
def test_statistics(text):
    got = rules.text_statistics([text, None])
    assert tuple(got[n][0] for n in NAMES) == brute(text)
    assert tuple(got[n][1] for n in NAMES) == (0, 0, 0, 0, 0)


def test_rules_find_two_kinds_of_bad_rows():
    random = np.random.default_rng(1)
    n = 3000
    values = {k: random.random(n) * 0.2 for k in ("a", "b", "c")}
    bad = np.zeros(n, bool)
    bad[:300], values["a"][:300] = True, 0.8
    bad[300:500], values["b"][300:500], values["c"][300:500] = True, 0.9, 0.6
    order = random.permutation(n)
    values, bad = {k: v[order] for k, v in values.items()}, bad[order]
    found = rules.learn_rules(values, bad)
    taken = np.zeros(n, bool)
    for rule in found:
        taken |= rules._covers(values, rule)
    assert (taken == bad).mean() > 0.99
    assert rules.learn_rules(values, np.zeros(n, bool)) == []
    assert rules.learn_rules({k: v[:0] for k, v in values.items()}, bad[:0]) == []


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    right = total = 0
    for r in queries.op2_quality_rules(spark, sf_dir).collect():
        words, chars, symbols, dup, repeat = brute(docs.pop(r["doc_id"])["text"])
        assert tuple(r[n] for n in NAMES) == (words, chars, symbols, dup, repeat)
        assert r["base_failed"] == (words < 10 or 100 * repeat > 20 * words)
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)
        if r["doc_id"] in labels and words >= 10:
            total += 1
            right += r["kept"] == (labels[r["doc_id"]] == 1)
    assert not docs and right / total > 0.95


def test_nulls_repeats_and_clashes(spark):
    good = "the quick brown fox jumps over the lazy dog near a river bank today"
    rows = [(1, None), (None, good), (2, good), (2, good), (3, ""), (4, "x " * 40000)]
    df = spark.createDataFrame(rows, "id int, body string").withColumn("n_words", queries.F.lit("z"))
    labels = spark.createDataFrame([(None, 1), (2, None), (2, 1), (9, 0)], "id int, good int")
    out = rules.quality_rules(df.withColumnRenamed("id", "doc"), "doc", "body", labels.withColumnRenamed("id", "doc"), "good")
    kept = sorted((r["doc"] is None, r["doc"] or 0, r["kept"]) for r in out.collect())
    assert kept == [(False, 1, False), (False, 2, True), (False, 2, True), (False, 3, False), (False, 4, False), (True, 0, True)]
    labels = labels.withColumnRenamed("id", "doc")
    left = rules.keep_good(df.withColumnRenamed("id", "doc"), "doc", "body", labels, "good")
    assert left.columns == ["doc", "body", "n_words"] and left.count() == 3
    assert rules.keep_good(df.limit(0).withColumnRenamed("id", "doc"), "doc", "body", labels.limit(0), "good").count() == 0
