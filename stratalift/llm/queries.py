"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from functools import partial, wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stratalift
from stratalift.llm import decontamination, langid, linededup, near_duplicates, packing, pages, quality, rules, sharding, tokenfiles, toxicity, vectorcodes, wordruns
from stratalift.llm.frames import fold
from stratalift.queries.registry import Query, table
from stratalift.staging import stage_rows, staging_path

WORD_TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_TOKENIZER)


def query(function: Query, sql: str | None = None) -> Query:
    if sql is not None:
        ORACLES[function.__name__] = sql

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, unless told otherwise."""
    root = str(Path(stratalift.__file__).resolve().parent.parent)
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.sha2(text, 256).alias("same"),
    )
    placed = sharding.shard_rows(docs, F.col("same"), F.col("size"), 24)
    return placed.drop("same").withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = rules.quality_rules(docs, "doc_id", "text", labels, "quality")
    names = ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept "
             "rule").split()
    return judged.select(*names)


@query
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages")
    model = pages.fit_pages(found, "page_id", "html")
    texts = pages.extract_text(found.select("page_id", "url", "html"), "html", model)
    return texts.select("page_id", "url", "text", "n_chars")


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, "doc_id", "text", items, "item_id", "text")


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    profiles = langid.fit_profiles(docs, "doc_id", "text", "lang", ~held_out)
    named = langid.identify(docs.select("doc_id", "text"), "text", profiles)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.cut_documents(docs, "doc_id", "text", word_tokenizer(), 1, 4096, digests=True)
    # a document has one piece at most that is not full
    return packing.pack_rows(pieces, "length", 4096, rows=docs.count())


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    weights, _ = toxicity.fit_toxicity(docs, "doc_id", "text", labels, "toxic", ~held_out)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), "text", weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    weights = quality.fit_quality(docs, "doc_id", "text", labels, "quality", ~held_out)
    scored = quality.score_quality(docs.select("doc_id", "text"), "text", weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    tokenfiles.write_token_files(docs, path, "doc_id", "text", word_tokenizer(), 2)
    back = tokenfiles.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text that is searched: that of every tenth id repeats from a word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr("filter(split(text, '[ \\\\t-\\\\r]+'), w -> w <> '')")
    drawn = F.when(h % 10 == 0, words)
    given = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), drawn.alias("words"))
    n = F.size("words")
    given = given.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    given = given.withColumn("p", (F.floor((n - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    again = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int"))
    made = F.concat(F.slice("words", 1, F.col("a")), F.slice(F.flatten(again), 1, n - F.col("a")))
    return given.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = wordruns.repeat_runs(docs, "text").withColumn("best", wordruns.longest_run(F.col("runs")))
    best = F.col("best")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


LINE_SQL = """WITH lines AS (
    SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
  each AS (SELECT rid, doc_id, t.pos, held[t.pos] AS line FROM lines, unnest(range(1, len(held) + 1)) AS t(pos)),
  keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
  frequent AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
  marked AS (SELECT rid, doc_id, pos, line, coalesce(doc_id <> holder, false) AS gone
    FROM keyed LEFT JOIN frequent USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid"""


@partial(query, sql=LINE_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = linededup.drop_repeated_lines(docs, "doc_id", "text")
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return left.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def vector_codes_sql(dimension: int = 64) -> str:
    """The codes of ``dimension`` components by comparing every part with every entry, round by round."""
    parts, entries, rounds = vectorcodes.PARTS, vectorcodes.ENTRIES, vectorcodes.ROUNDS
    width = dimension // parts
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings
    WHERE len(embedding) = {dimension} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  comp AS MATERIALIZED (SELECT rid, j // {width} AS part, j % {width} AS place,
    CAST(floor({vectorcodes.SCALE} * CAST(embedding[j + 1] AS DOUBLE)) AS BIGINT) AS v
    FROM kept, range({dimension}) AS t(j)),
  first AS (SELECT min(rid) AS rid, vec_id FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id
    ORDER BY vec_id LIMIT {entries}),
  book0 AS (SELECT part, f.entry, place, v FROM comp JOIN
    (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM first) f USING (rid))"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT rid, part, entry, d FROM (
    SELECT c.rid, c.part, b.entry, CAST(sum((c.v - b.v) * (c.v - b.v)) AS BIGINT) AS d
    FROM comp c JOIN book{r} b ON c.part = b.part AND c.place = b.place GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT part, entry, place,
    CAST(CASE WHEN n IS NULL THEN v ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS v
    FROM book{r} LEFT JOIN (SELECT part, entry, place, sum(v) AS s, count(*) AS n
      FROM comp JOIN near{r} USING (rid, part) GROUP BY ALL) USING (part, entry, place))"""
            )
    return f"""WITH {', '.join(steps)},
  coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)"""


@partial(query, sql=vector_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vectorcodes.fit_codebooks(vectors, "vec_id", "embedding")
    coded = stage_rows(vectorcodes.encode(vectors, "embedding", books).drop("embedding"), "codes")
    summed = vectorcodes.with_label_error(coded, "label")
    digest = F.lit(books.digest() if books else None).cast("string")
    return summed.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
