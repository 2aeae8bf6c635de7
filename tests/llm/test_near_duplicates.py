import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalift.llm import near_duplicates, queries, superminhash
from stratalift.llm.components import connected


def brute_set(text):
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent):
    """Components over all pairs."""
    sets = {d: brute_set(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    pairs = {}
    for ds in holders.values():
        for k, a in enumerate(ds):
            for b in ds[:k]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def slow_signature(found, places):
    """One element after the other, as the method is written down."""
    out = [superminhash.UNSET] * places
    for element in found:
        order = list(range(places))
        for rank in range(places):
            value = int(superminhash.mix(np.array([element + superminhash.SEEDS[rank]]))[0])
            swap = rank + ((value & 0xFFFFFFFF) * (places - rank) >> 32)
            order[rank], order[swap] = order[swap], order[rank]
            out[order[rank]] = min(out[order[rank]], value >> 32 | rank << 32)
    return [int(x) for x in out]


@pytest.mark.parametrize("size", [0, 1, 2, 7, 60, 900])
def test_signature(size):
    found = np.random.default_rng(size).integers(0, 2**63, size, dtype=np.uint64)
    assert superminhash.signature(found, 20).tolist() == slow_signature(found, 20)


def test_word_hashes_name_words(spark, sf_dir):
    known = {}
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in [*texts, None, "", " \n", "A a\tÉ é\x85x\x1c y " + "z" * 5000]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
        hashes = superminhash.word_hashes(text).tolist()
        assert len(words) == len(hashes)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(known.values())) == len(known)


def test_signature_estimates_similarity():
    random_ = np.random.default_rng(3)
    shares = []
    for _ in range(40):
        both, a, b = (random_.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 20, 20))
        one, two = (superminhash.signature(np.concatenate([both, x]), 125) for x in (a, b))
        shares.append((one == two).mean())
    assert abs(np.mean(shares) - 0.6) < 0.02


def test_components(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, 3), (3, 5), (9, 9), (160, 2), (7, 3)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 2 for k in range(100, 161)}, 2: 2, 5: 3, 3: 3, 7: 3}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def judged(df, percent=85):
    out = near_duplicates.near_duplicates(df, "doc_id", "text", percent).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out}, out


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = queries.QUERIES["op4_near_duplicates"](spark, sf_dir).collect()
    wanted = brute([tuple(r) for r in docs.collect()], 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


@pytest.mark.parametrize(("small", "rare", "percent"), [(32, 16, 85), (2, 2, 85), (2, 2, 80)])
def test_chains_and_large_groups(spark, small, rare, percent, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_duplicates, "RARE", rare)
    dice = random.Random(4)
    base = [f"w{dice.randrange(500)}" for _ in range(200)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(dice.randrange(12)):
            words[dice.randrange(200)] = f"e{dice.randrange(10**6)}"
        rows.append((k + 10, " ".join(words)))
    chain = list(base)[:120]
    for k in range(8):  # each near the one before, the ends far apart
        chain[k * 15] = f"c{k}"
        rows.append((300 + k, " ".join(chain)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert judged(df, percent)[0] == brute(rows, percent)


def test_nulls_short_repeats_and_clashes(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(3, "A b"), (1, "a B"), (2, "a"), (4, None), (5, ""), (6, " \n"), (None, "a b"), (1, "a B"), (8, long), (9, long + " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", queries.F.lit("x"))
    got, out = judged(df)
    assert len(out) == 10
    assert got == {3: (1, 1), 1: (1, 1), 2: (1, 2), 4: (0, 4), 5: (0, 5), 6: (0, 6), None: (1, None), 8: (29996, 8), 9: (29997, 8)}
    left = near_duplicates.keep_one(df, "doc_id", "text")
    assert left.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left.collect()) == [(False, d) for d in (1, 1, 2, 4, 5, 6, 8)] + [(True, 0)]
    assert judged(df.limit(0))[1] == []


def test_rows_of_one_id_follow_their_own_text(spark):
    text, other = " ".join(f"w{k}" for k in range(20)), " ".join(f"o{k}" for k in range(20))
    rows = [(1, text, 1), (2, text, 2), (2, other, 3), (2, None, 4), (2, text, 5), (3, other + " x", 6), (3, "", 7)]
    df = spark.createDataFrame(rows, "doc_id int, text string, __gone int")
    assert sorted(r["__gone"] for r in near_duplicates.keep_one(df, "doc_id", "text").collect()) == [1, 3, 4, 7]


def test_nothing_staged_is_left_but_the_result(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "stratalift"
    before = set(folder.glob("*"))
    rows = [(k, " ".join(f"w{j}" for j in range(20 + k % 3))) for k in range(9)]
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    (left,) = set(folder.glob("*")) - before
    assert left.name.startswith("near-duplicates-") and out.count() == 9


def test_pairs_of_the_prefix_index_are_not_estimated(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", 1)
    monkeypatch.setattr(near_duplicates, "SLACK", -100.0)  # no signatures are near enough
    rows = []
    for group in range(3):
        base = [f"g{group}w{k}" for k in range(100)]
        rows += [(10 * group + k, " ".join([*base[:k], f"e{k}", *base[k + 1 :]])) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute(rows, 85)
    assert len({c for _, c in wanted.values()}) == 3
    assert judged(df)[0] == wanted


@pytest.mark.parametrize("percent", [80, 85])
def test_estimate_loses_less_than_banding(percent):
    least, share = near_duplicates.Links(None, percent).least, percent / 100
    places = near_duplicates.PLACES
    below = sum(math.comb(places, k) * share**k * (1 - share) ** (places - k) for k in range(least))
    bands, size = near_duplicates.bands_and_rows(percent)
    assert below < (1 - share**size) ** bands / 100
