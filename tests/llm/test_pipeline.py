from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from stratalift.llm import decontamination, queries, toxicity

from .test_decontamination import holds
from .test_near_duplicates import brute
from .test_tokens import placed


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "toxicity", "near duplicates", "decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def run(name, given):
        out = spark.createDataFrame(stages[name](spark, given, sf_dir).collect(), docs.schema)
        assert out.columns == docs.columns
        return out

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    good = run("quality rules", docs)
    judged = queries.QUERIES["op2_quality_rules"](spark, sf_dir)
    assert ids(good) == ids(judged.where("kept"))

    clean = run("toxicity", good)
    weights, _ = toxicity.fit_toxicity(good, "doc_id", "text", labels, "toxic")
    scorer = toxicity.Scorer(weights)
    assert ids(clean) == sorted(r["doc_id"] for r in good.collect() if scorer.score(r["text"]) < 0.5)

    single = run("near duplicates", clean)
    groups = brute([(r["doc_id"], r["text"]) for r in clean.collect()], 80)
    assert ids(single) == sorted(d for d, (_, root) in groups.items() if d == root)

    apart = run("decontamination", single)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    sets = [(i["text"], decontamination.shingles(decontamination.words_of(i["text"]))) for i in items]
    left = []
    for r in single.collect():
        held = decontamination.shingles(decontamination.words_of(r["text"]))
        near = [t for t, s in sets if len(s & held) >= 0.8 * len(s)]
        if not any(holds(r["text"], t) for t in near):
            left.append(r["doc_id"])
    assert ids(apart) == sorted(left)

    packed = stages["packing"](spark, apart, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(left)
    assert placed(packed, 4096) <= 1.05 * sum(r["length"] for r in packed) / 4096 + 1

    whole = queries_run(spark, sf_dir)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed
    )


def queries_run(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir).collect()


def test_stages_with_rows_of_all_kinds(spark, sf_dir):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text + " more", None, None, None), (None, text, "en", "s", 1)]
    rows += [(3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "few words", "en", "s", 9), (6, "long " * 100_000, "en", "s", 5)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    given = given.withColumns({"Score": F.lit("x"), "__id": F.lit(1), "kept": F.lit(True), "ids": F.lit("y")})
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in df.collect())

    left = {name: stages[name](spark, given, sf_dir) for name in stages}
    assert ids(left["quality rules"]) == [-1, 1, 1, 2] or ids(left["quality rules"]) == []
    assert ids(left["toxicity"]) == [-1, 1, 1, 2, 3, 4, 5, 6]
    assert ids(left["near duplicates"]) == [-1, 1, 1, 3, 4, 5, 6]
    assert ids(left["decontamination"]) == [-1, 1, 1, 2, 3, 4, 5, 6]
    assert set(ids(left["packing"])) == {-1, 1, 2, 3, 4, 5, 6}
    for name in list(stages)[:-1]:
        assert left[name].columns == given.columns
        assert stages[name](spark, given.limit(0), sf_dir).count() == 0
    assert stages["packing"](spark, given.limit(0), sf_dir).count() == 0


def test_nothing_staged_is_left_but_the_result(spark, sf_dir):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "stratalift"
    before = set(folder.glob("*"))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    (left,) = set(folder.glob("*")) - before
    assert left.name.startswith("packing-")
