import zlib
from collections import Counter

from pyspark.sql import functions as F

from stratalift.llm import langid, queries


def brute(text):
    found = Counter()
    lower = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    for word in lower.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            found.update(g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]).strip())
    return found


def as_number(gram):
    return sum(ord(c) << 21 * k for k, c in enumerate(gram))


def test_ngrams():
    for text in ("The cat, the CAT-12 sät.", "", None, "  12 !! ", "日本 a", "x"):
        grams, counts = langid.ngrams(text)
        wanted = {as_number(g): n for g, n in brute(text).items()}
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == wanted


def test_equal_counts_share_their_rank():
    assert langid._ranks(langid.np.array([9, 5, 5, 5, 1])).tolist() == [0, 2, 2, 2, 4]


def test_distance_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = langid.fit_profiles(docs, "doc_id", "text", "lang", per_language=10, length=50)
    text = docs.orderBy("doc_id").first()["text"]
    counts = sorted(brute(text).items(), key=lambda g: (-g[1], as_number(g[0])))[:40]
    rank_of = {n: sum(r for r, (_, m) in enumerate(counts) if m == n) / sum(m == n for _, m in counts) for _, n in counts}
    totals = []
    for at in range(len(profiles.languages)):
        ranks = dict(zip(profiles.grams.tolist(), profiles.ranks[:-1, at], strict=True))
        total = 0
        for gram, n in counts:
            rank = ranks.get(as_number(gram), -1)
            total += 50 if rank < 0 else min(50, abs(rank - rank_of[n]))
        totals.append(total)
    best = min(range(len(totals)), key=totals.__getitem__)
    name, score = profiles.nearest(text, 40)
    assert name == profiles.languages[best] and abs(score - (1 - totals[best] / (50 * len(counts)))) < 1e-9


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    right = total = 0
    for r in queries.QUERIES["op6_language"](spark, sf_dir).collect():
        doc = docs.pop(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            total += 1
            right += r["lang_pred"] == doc["lang"]
    assert not docs and right / total > 0.95


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, "the house and the garden", "en"), (1, "the house and the garden", "en")]
    rows += [(2, "das haus und der garten", "de"), (None, "x", "fr"), (3, None, "es"), (4, "12", None), (5, "y " * 90000, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("Score", F.lit(1))
    profiles = langid.fit_profiles(df, "doc_id", "text", "lang")
    assert profiles.languages == ["de", "en"]
    out = langid.identify(df, "text", profiles)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [r["lang_pred"] for r in out.collect()][:3] == ["en", "en", "de"]
    assert [(r["lang_pred"], r["score"]) for r in out.collect()][4:6] == [("und", 0.0)] * 2
    none = langid.fit_profiles(df.limit(0), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in langid.identify(df, "text", none).collect()} == {"und"}
    assert langid.identify(df.limit(0), "text", none).count() == 0
