import zlib

import numpy as np
from pyspark.sql import functions as F

from stratalift.llm import ftrl, quality, queries


def test_ftrl_learns_and_is_sparse():
    random = np.random.default_rng(3)
    examples, targets = [], []
    for _ in range(600):
        places = np.unique(random.integers(0, 50, 8))
        targets.append(float(7 in places))
        examples.append((places, np.ones(len(places))))
    weights = ftrl.train(examples, np.array(targets), 50, alpha=0.5, l1=8.0)
    scores = np.array([ftrl.sigmoid(weights[p] @ v + weights[-1]) for p, v in examples])
    assert ((scores > 0.5) == (np.array(targets) > 0.5)).mean() > 0.97
    assert (weights[:50] == 0).sum() > 20
    assert not ftrl.train([], np.array([]), 4).any()


def test_ftrl_against_plain_coordinates():
    """Follow the proximally regularised leader, a coordinate at a time, by its definition."""
    random = np.random.default_rng(4)
    examples = [(p := np.unique(random.integers(0, 12, 5)), random.normal(size=len(p))) for _ in range(80)]
    targets = random.random(80)
    alpha, beta, l1, l2, size, rounds = 0.3, 0.7, 0.2, 0.1, 12, 3
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        bound, ridge = (0.0, 0.0) if i == size else (l1, l2)
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - np.sign(z[i]) * bound) / ((beta + np.sqrt(n[i])) / alpha + ridge)

    order = np.random.default_rng(7)
    for _ in range(rounds):
        for at in order.permutation(80).tolist():
            row = [*zip(examples[at][0].tolist(), examples[at][1].tolist(), strict=True), (size, 1.0)]
            now = {i: weight(i) for i, _ in row}
            error = 1 / (1 + np.exp(-sum(now[i] * v for i, v in row))) - targets[at]
            for i, v in row:
                g = error * v
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * now[i]
                n[i] += g * g
    found = ftrl.train(examples, targets, size, alpha, beta, l1, l2, rounds)
    assert np.allclose(found, [weight(i) for i in range(size + 1)])


def test_score_is_the_sparse_dot_product():
    weights = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    text = "The the cat SAT!! on\nthe the mat 12"
    dense = np.zeros(len(weights))
    places, values = quality.features(text)
    dense[places], dense[-1] = values, 1
    assert abs(quality.score(text, weights) - ftrl.sigmoid(dense @ weights)) < 1e-12
    assert abs((values**2).sum() - 1) < 1e-9
    assert quality.score(None, weights) == quality.score("", weights) == ftrl.sigmoid(weights[-1])


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = queries.op9_quality_classifier(spark, sf_dir).join(labels, "doc_id", "left").collect()
    assert len(out) == docs.count()
    right = wrong = 0
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and r["quality"] is not None:
            right += r["predicted"] == r["quality"]
            wrong += r["predicted"] != r["quality"]
    assert right / (right + wrong) > 0.93


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, "good words here"), (1, "good words here"), (None, None), (2, ""), (3, "x " * 50000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("Score", F.lit("s"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id int, good int")
    weights = quality.fit_quality(df, "doc_id", "text", labels, "good")
    out = quality.score_quality(df, "text", weights)
    assert out.columns == ["doc_id", "text", "score"]
    assert [r["score"] is not None for r in out.collect()] == [True] * 5
    none = quality.fit_quality(df.limit(0), "doc_id", "text", labels.limit(0), "good")
    assert not none.any() and quality.score_quality(df.limit(0), "text", none).count() == 0
