"""The corpus pipeline: documents in, packed sequences out.

Each stage works on all that the one before kept; all but the last return the
columns of ``documents``, whatever their names. Whole texts are read, however long. Rows
with a NULL or empty text have no words, fail the first stage and go there; where a
later stage is given them, it keeps them. Rows with a NULL id are judged by their text like
others and only learned from by none. Repeated rows have the same fate, but for near
duplicates, which know documents by id. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalift.llm import decontamination, near_duplicates, packing, rules, toxicity
from stratalift.llm.queries import find_package, word_tokenizer
from stratalift.queries.registry import table
from stratalift.staging import delete_folder, scratch, stage_rows, staging_path

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what fails the base rules or a learned one.

    A NULL or empty text fails the base rules. Ties between conditions go to the first in a fixed
    order, so the rules do not depend on the order of rows.
    """
    find_package(spark)
    return rules.keep_good(docs, "doc_id", "text", table(spark, sf_dir, "labels"), "quality")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic, from 0.5 on. A NULL or empty text scores as the
    intercept says, which is below that unless most labels are toxic."""
    find_package(spark)
    labels = table(spark, sf_dir, "labels")
    weights, _ = toxicity.fit_toxicity(docs, "doc_id", "text", labels, "toxic")
    return toxicity.drop_toxic(docs, "text", weights)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near duplicates.

    Repeated rows of an id stay or go together, texts of one id each follow their own; rows with a
    NULL id and texts without words stay.
    """
    find_package(spark)
    return near_duplicates.keep_one(docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item. NULL and empty texts and items hold nothing."""
    find_package(spark)
    items = table(spark, sf_dir, "benchmark")
    return decontamination.drop_contaminated(docs, "text", items, "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens: a row per piece.

    A NULL or empty text is one piece with the end id alone. Repeated rows are packed each.
    """
    find_package(spark)
    pieces = packing.cut_documents(docs, "doc_id", "text", word_tokenizer(), 1, 4096, digests=True)
    return packing.pack_rows(pieces, "length", 4096, rows=docs.count())


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxic),
    ("near duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage stages for itself, and its input, go when it is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            docs = stage_rows(stage(spark, docs, sf_dir), path=path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
