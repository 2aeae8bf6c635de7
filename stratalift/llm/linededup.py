"""Line deduplication: bitmaps of the lines each document keeps.

Hashes of lines are dealt to range partitions and sorted there by hash, document and
line number. One pass over a partition marks a line's first occurrence in each
document; counts of these say which lines too many documents have. As the document is part
of the range key, a line that a third of all documents share is spread over many partitions,
and the counts are summed up before they are shuffled. No text takes part in any of
this: the result is one compressed bitmap per document that loses lines, and a
last pass over the texts applies it.
"""

from __future__ import annotations

import string
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalift.llm.frames import column, free_name, without
from stratalift.staging import staged, stage_rows

BLANK = " \t\n\v\f\r"
LEAST_CHARS, LEAST_DOCS = 40, 5
WORD_BITS = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANK))
    latin = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    # lower() is faster and the same for ASCII
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(latin)


def version_of(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def line_occurrences(df: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """``h1`` and ``h2`` (128 bits of a line's key), ``doc``, ``version``, ``pos`` and ``first``.

    One row per line of enough characters and document with an id, in range partitions by
    hash and document. ``first`` marks the key's first row of its document.
    """
    given = df.select(column(doc_id).alias("doc"), column(text).cast("string").alias("text"))
    given = given.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    each = given.select("doc", version_of(F.col("text")).alias("version"), F.posexplode(lines_of(F.col("text"))))
    long_ones = each.where(F.char_length(F.btrim("col", F.lit(BLANK))) >= least_chars)
    key = line_key(F.col("col"))
    # another leading value is another seed, so the two halves do not collide together
    hashed = long_ones.select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc", "version", "pos"
    )
    place = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    stream = hashed.repartitionByRange(*place).sortWithinPartitions(*place, "pos", "version")
    within = Window.partitionBy("h1", "h2", "doc").orderBy("pos", "version")
    return stream.withColumn("first", F.row_number().over(within) == 1)


def keep_bitmaps(
    df: DataFrame,
    doc_id: str,
    text: str,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """``doc``, ``version``, ``n_dropped`` and ``bitmap`` of every document that loses lines.

    Lines whose key (``line_key``) has at least ``least_chars`` code points and stands in at
    least ``least_docs`` documents are dropped, all of them, except in the largest id
    that holds it, where all of them stay. A bitmap is a list of (``skip``, ``bits``): after
    ``skip`` words of 64 lines that all stay comes a word whose lowest bit is its
    first line, set where the line stays; lines behind the last word stay.

    NULL and empty texts have no line that is long enough. Documents with a NULL id
    neither count nor lose lines. Repeated rows of an id count as one document; rows of
    one id with different texts (told apart by ``version_of``) count as one and each have
    their own bitmap. An empty table has no bitmaps.
    """
    with ExitStack() as stack:
        occurrences = stack.enter_context(staged(line_occurrences(df, doc_id, text, least_chars), "lines"))
        counts = occurrences.groupBy("h1", "h2").agg(
            F.count_if("first").alias("n_docs"), F.max("doc").alias("holder")
        )
        few = counts.where(F.col("n_docs") >= least_docs).select("h1", "h2", "holder")
        # staged, so that nothing stands between exchange and join and Spark splits hot keys
        frequent = stack.enter_context(staged(few, "frequent"))
        dropped = occurrences.join(frequent, ["h1", "h2"]).where(F.col("doc") != F.col("holder"))
        bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
        words = dropped.groupBy("doc", "version", F.expr(f"pos div {WORD_BITS}").cast("int").alias("word")).agg(
            F.bit_or(bit).alias("gone")
        )
        listed = words.groupBy("doc", "version").agg(
            F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
            F.sort_array(F.collect_list(F.struct("word", "gone"))).alias("words"),
        )
        before = F.when(F.size("words") > 1, F.slice("words", 1, F.size("words") - 1)).otherwise(F.slice("words", 1, 0))
        earlier = F.concat(F.array(F.lit(-1)), before["word"])
        bitmap = F.zip_with(
            "words",
            earlier,
            lambda w, last: F.struct((w["word"] - last - 1).alias("skip"), F.bitwise_not(w["gone"]).alias("bits")),
        )
        return stage_rows(listed.select("doc", "version", "n_dropped", bitmap.alias("bitmap")), "bitmaps")


def kept_flags(bitmap: Column) -> Column:
    """Whether each line stays, as an array; lines behind its end stay."""
    words = F.flatten(
        F.transform(bitmap, lambda b: F.concat(F.array_repeat(F.lit(-1).cast("long"), b["skip"]), F.array(b["bits"])))
    )
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    return F.flatten(F.transform(words, lambda w: F.transform(bits, lambda k: F.getbit(w, k) == 1)))


def apply_bitmaps(df: DataFrame, doc_id: str, text: str, bitmaps: DataFrame) -> DataFrame:
    """The rows with ``n_lines`` (before), ``n_dropped`` and ``kept_text``.

    A NULL text is one empty line. Columns of these names are replaced, all others are kept.
    """
    given = without(df, "n_lines", "n_dropped", "kept_text")
    own = {name: free_name(given, f"__{name}") for name in ("doc", "version", "bitmap")}
    maps = bitmaps.select(
        F.col("doc").alias(own["doc"]), F.col("version").alias(own["version"]), F.col("bitmap").alias(own["bitmap"]),
        "n_dropped",
    )
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    same = (column(doc_id) == maps[own["doc"]]) & (version_of(body) == maps[own["version"]])
    met = given.join(maps, same, "left")
    lines = F.arrays_zip(lines_of(body).alias("line"), kept_flags(F.col(own["bitmap"])).alias("stays"))
    left = F.filter(lines, lambda x: x["line"].isNotNull() & F.coalesce(x["stays"], F.lit(True)))
    kept = F.when(F.col(own["bitmap"]).isNull(), body).otherwise(F.array_join(left["line"], "\n"))
    n_lines = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit(""))) + 1
    return met.select(
        *[column(c) for c in given.columns],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )


def drop_repeated_lines(
    df: DataFrame, doc_id: str, text: str, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """The rows with ``n_lines``, ``n_dropped`` and ``kept_text``; see ``keep_bitmaps``."""
    return apply_bitmaps(df, doc_id, text, keep_bitmaps(df, doc_id, text, least_chars, least_docs))
