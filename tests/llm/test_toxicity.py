import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalift.llm import queries, toxicity
from stratalift.llm.labelmodel import fit_label_model


def test_label_model_finds_accuracies_and_echoes():
    random = np.random.default_rng(5)
    n = 6000
    truth = random.random(n) < 0.3
    votes = np.zeros((n, 5), np.int64)
    for voter, accuracy in enumerate((0.95, 0.8, 0.75, 0.7)):
        right = random.random(n) < accuracy
        votes[:, voter] = np.where(truth == right, 1, -1)
    votes[:, 4] = np.where(random.random(n) < 0.97, votes[:, 3], -votes[:, 3])  # an echo
    model = fit_label_model(votes)
    assert model.correlation[3, 4] > 0.5 > abs(model.correlation[0, 1]) + 0.3
    assert model.weight[4] < 0.7 < model.weight[0]
    assert abs(model.said[0, 1, 2] - 0.95) < 0.05 and abs(model.said[1, 0, 0] - 0.8) < 0.07
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93
    assert fit_label_model(votes[:0]).posterior(votes[:0]).shape == (0,)


def test_posterior_is_that_of_all_labels_enumerated():
    random = np.random.default_rng(8)
    truth = random.random(4000) < 0.25
    votes = np.zeros((4000, 4), np.int64)
    for voter, (hit, false) in enumerate(((0.7, 0.05), (0.5, 0.1), (0.9, 0.3), (0.4, 0.02))):
        votes[:, voter] = np.where(random.random(4000) < np.where(truth, hit, false), 1, -1)
    votes[random.random(votes.shape) < 0.2] = 0
    model = fit_label_model(votes)
    assert model.groups == [[0], [1], [2], [3]]  # agreeing because they are right is no echo
    for row in votes[:200]:
        joint = [
            p * np.prod([model.said[v, label, vote + 1] for v, vote in enumerate(row)])
            for label, p in ((0, 1 - model.prior), (1, model.prior))
        ]
        assert abs(model.posterior(row[None])[0] - joint[1] / sum(joint)) < 1e-9
    echoed = np.column_stack([votes, votes[:, :1], votes[:, :1]])
    echo = fit_label_model(echoed)
    assert [0, 4, 5] in echo.groups and echo.weight[0] < 0.4
    # a group says as much as its best voter and not three times that
    assert abs(echo.posterior(echoed) - model.posterior(votes)).max() < 0.15


@pytest.mark.parametrize("n", [20, 50, 200, 800, 8000])
@pytest.mark.parametrize("rate", [0.01, 0.1, 0.5])
def test_given_labels_are_not_outvoted(n, rate):
    """Three in ten toxic documents have no mark at all; the label alone says so."""
    random = np.random.default_rng(n)
    toxic = np.arange(n) < max(1, round(n * rate))
    marked = toxic & (random.random(n) < 0.7)
    votes = np.zeros((n, 7), np.int64)
    votes[:, 0] = marked & (random.random(n) < 0.9)
    votes[:, 1] = marked & (random.random(n) < 0.6)
    votes[:, 2] = votes[:, 1]
    votes[:, 3] = votes[:, 0] & (random.random(n) < 0.8)
    votes[:, 4] = random.random(n) < 0.01
    votes[:, 5] = np.where(votes[:, :5].any(axis=1), 0, -1)
    votes[:, 6] = np.where(toxic, 1, -1)
    model = fit_label_model(votes, given=-1)
    belief = model.posterior(votes)
    assert (belief[~toxic] < 0.5).mean() > 0.97
    assert (belief[marked] > 0.5).all()
    if toxic.sum() >= 5:
        assert (belief[toxic] > 0.5).mean() >= (0.9 if toxic.sum() >= 20 else 0.6)
    assert abs(model.prior - toxic.mean()) < 1 / np.sqrt(n)


@pytest.mark.parametrize("n, least", [(40, 0.4), (300, 0.7), (800, 0.8), (2000, 0.9)])
def test_recall_by_number_of_labels(n, least):
    docs = {d["doc_id"]: d["text"] for d in read("documents")}
    known = [(docs[r["doc_id"]], r["toxic"]) for r in read("labels") if r["doc_id"] in docs]
    known = [known[k] for k in np.random.default_rng(0).permutation(len(known))]
    held, taught = known[:800], known[800 : 800 + n]
    texts = [toxicity.words_of(t) for t, _ in taught]
    hidden = [toxicity.hidden_words(t.lower()) for t, _ in taught]
    weights, _ = toxicity.fit_words(texts, hidden, np.array([y for _, y in taught]))
    scorer = toxicity.Scorer(weights)
    found = [(scorer.score(t) >= 0.5, y) for t, y in held]
    caught = sum(p for p, y in found if y) / sum(y for _, y in found)
    assert caught >= least and sum(p for p, y in found if not y) <= 8


def read(name):
    return pq.read_table(f"/root/testdata/sf0.1/{name}.parquet").to_pylist()


def test_hidden_words():
    assert {"idiot", "scum"} <= toxicity.hidden_words("you 1d1ot 1di0t s.c.u.m or s c u m".lower()) | {"idiot"}
    assert "scum" in toxicity.words_of("S C U M") and "moron" in toxicity.words_of("m0r0n")
    assert toxicity.words_of(None) == set()


def test_score_is_the_sparse_dot_product():
    weights = np.random.default_rng(2).normal(size=(1 << toxicity.BITS) + 1)
    text = "A loser and a worthless, losers WORTHLESS"
    places, values = toxicity.features(toxicity.words_of(text))
    whole = weights[places] @ values + weights[-1]
    scorer = toxicity.Scorer(weights)
    assert abs(scorer.score(text) - 1 / (1 + np.exp(-whole))) < 1e-9
    assert scorer.score(None) == scorer.score("")


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = queries.op8_toxicity(spark, sf_dir).join(labels, "doc_id", "left").collect()
    assert len(out) == docs.count()
    right = wrong = 0
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["toxic"] is not None:
            right += r["predicted"] == r["toxic"]
            wrong += r["predicted"] != r["toxic"]
    assert right / (right + wrong) > 0.97


def test_nulls_repeats_and_clashes(spark):
    rows = [(k, "you idiot moron") for k in range(5)] + [(k, "fine day") for k in range(5, 20)]
    rows += [(1, "you idiot moron"), (None, None), (21, ""), (22, "x " * 50000), (23, "loser")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("Score", F.lit("s"))
    known = [(k, int(k < 5)) for k in range(20)] + [(21, None), (None, 1)]
    labels = spark.createDataFrame(known, "doc_id int, bad int")
    weights, _ = toxicity.fit_toxicity(df, "doc_id", "text", labels, "bad")
    out = toxicity.score_toxicity(df, "text", weights)
    assert out.columns == ["doc_id", "text", "score"]
    scores = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert min(scores[k, "you idiot moron"] for k in range(5)) > 0.5 > max(scores[k, "fine day"] for k in range(5, 20))
    left = toxicity.drop_toxic(df, "text", weights)
    assert left.columns == df.columns and "you idiot moron" not in {r["text"] for r in left.collect()}
    none, _ = toxicity.fit_toxicity(df.limit(0), "doc_id", "text", labels.limit(0), "bad")
    assert toxicity.score_toxicity(df.limit(0), "text", none).count() == 0
