"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

Texts of the same shingles form a class, which its smallest document stands
for. Classes that agree in a band of their signatures share a bucket. In each
bucket all are compared with its smallest member, and verified links are
joined to components. Only buckets that still hold several components need
more: small ones compare the members of different components; the members of
large ones go through an exact prefix index, which no pair of enough
similarity escapes (``_indexed``) and whose pairs are all compared on full sets.
Elsewhere sets whose signatures are far apart are not compared (``SLACK``). So a group of thousands of copies costs links
to one of them, and no link between different texts is lost to a cap.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalift.llm import superminhash
from stratalift.llm.components import connected
from stratalift.llm.frames import column, free_name, text_column
from stratalift.staging import scratch, stage_rows, staging_path

PLACES = 125
# Standard deviations that the share of equal places may fall short before sets are not compared.
# At seven, sets of just 80 or 85 % fall short with a probability of 3e-11 or 1.5e-10 by the
# binomial, far less than that of sharing no band.
SLACK = 7.0
SMALL_BUCKET = 32
# A shingle of so few nodes is rare: all its pairs are compared.
RARE = 16


def bands_and_rows(percent: int) -> tuple[int, int]:
    """Bands of four or five places, such that sets of just enough similarity miss all bands
    with a probability below one in a million."""
    for rows in (5, 4, 3, 2):
        bands = PLACES // rows
        if (1 - (percent / 100) ** rows) ** bands < 1e-6:
            return bands, rows
    return PLACES, 1


def _sketches(bands: int, rows: int, texts: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {"n_shingles": [], "digest": [], "keys": [], "places": []}
    for text in texts:
        found = superminhash.shingles(text)
        sketch = superminhash.signature(found, PLACES)
        some = len(found) > 0
        out["n_shingles"].append(len(found))
        out["digest"].append(superminhash.digest(found) if some else None)
        out["keys"].append(superminhash.band_keys(sketch, bands, rows).tolist() if some else [])
        # sixteen bits a place are enough to estimate by
        out["places"].append((sketch & np.uint64(0xFFFF)).astype("<u2").tobytes())
    return out


def _set(text: Column, digest: Column) -> Column:
    """The shingles of the text, NULL if they are not those of the digest.

    The digest comes from the other side of a join, so only texts that the join keeps
    are read.
    """

    def sets(texts: pd.Series, digests: pd.Series) -> pd.Series:
        found = [superminhash.shingles(t if isinstance(t, str) else None) for t in texts]
        pairs = zip(found, digests, strict=True)
        return pd.Series(
            [f.astype("<u8").tobytes() if superminhash.digest(f) == d else None for f, d in pairs],
            dtype=object,
        )

    return F.pandas_udf(sets, "binary")(text, digest)


def _agree(a: Column, b: Column) -> Column:
    """How many places of two signatures are equal."""

    def count(first: pd.Series, second: pd.Series) -> pd.Series:
        pairs = zip(first, second, strict=True)
        same = [(np.frombuffer(x, "<u2") == np.frombuffer(y, "<u2")).sum() for x, y in pairs]
        return pd.Series(same, dtype="int64")

    return F.pandas_udf(count, "long")(a, b)


def _common(a: Column, b: Column) -> Column:
    """How many shingles two sets have in common."""

    def count(first: pd.Series, second: pd.Series) -> pd.Series:
        both = [
            len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
            for x, y in zip(first, second, strict=True)
        ]
        return pd.Series(both, dtype="int64")

    return F.pandas_udf(count, "long")(a, b)


class Links:
    """Candidate pairs in, verified links and components out."""

    def __init__(self, sets: DataFrame, percent: int) -> None:
        self.sets, self.percent = sets, percent
        share = percent / 100
        self.least = math.floor(PLACES * share - SLACK * math.sqrt(PLACES * share * (1 - share)))
        self.links: DataFrame | None = None

    def verify(self, pairs: DataFrame, estimate: bool = True) -> int:
        """Keep those of the pairs ``a``, ``b`` that are similar enough. Returns their number.

        Sets whose signatures differ too much are not compared, unless ``estimate`` is false.
        """

        def side(name: str, *more: str) -> DataFrame:
            named = [F.col(c).alias(f"{c}_{name}") for c in ("n", *more)]
            return self.sets.select(F.col("node").alias(name), *named)

        n_a, n_b = F.col("n_a"), F.col("n_b")
        near = pairs
        if estimate:
            sized = pairs.join(side("a", "places"), "a").join(side("b", "places"), "b")
            sized = sized.where(100 * F.least(n_a, n_b) >= self.percent * F.greatest(n_a, n_b))
            near = sized.where(_agree(F.col("places_a"), F.col("places_b")) >= self.least)
        full = near.select("a", "b").join(side("a", "shingles"), "a").join(side("b", "shingles"), "b")
        both = full.withColumn("common", _common(F.col("shingles_a"), F.col("shingles_b")))
        enough = 100 * F.col("common") >= self.percent * (n_a + n_b - F.col("common"))
        found = stage_rows(both.where(enough).select("a", "b").distinct(), "verified")
        count = found.count()
        if count:
            more = found if self.links is None else self.links.unionByName(found)
            stars = connected(more)
            self.links = stars.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return count

    def with_component(self, df: DataFrame, node: str) -> DataFrame:
        """``df`` with ``component``: that of its ``node``, which is itself where it has no link."""
        if self.links is None:
            return df.withColumn("component", F.col(node))
        known = self.links.select(F.col("a").alias(node), F.col("b").alias("component"))
        joined = df.join(known, node, "left")
        return joined.withColumn("component", F.coalesce("component", node))

    def mixed(self, members: DataFrame) -> DataFrame:
        """Rows (``key``, ``node``) of keys that hold several components, with theirs."""
        known = self.with_component(members, "node")
        keys = known.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
        )
        several = keys.where(F.col("low") != F.col("high")).select("key", "size")
        return _with_key_facts(known, several)


def _with_key_facts(members: DataFrame, facts: DataFrame) -> DataFrame:
    """``members`` with what ``facts`` says of their key.

    The facts, a row per key, come out of an aggregation. They are staged, so that nothing stands
    between exchange and join and Spark splits the keys of many members.
    """
    return members.join(stage_rows(facts, "facts"), "key")


def _across(members: DataFrame, condition: Column) -> DataFrame:
    """Pairs of members of a key that are of different components.

    ``members`` is a staged table, so that Spark splits the keys of very many members.
    """
    a, b = members.alias("x"), members.alias("y")
    pairs = a.join(b, (F.col("x.key") == F.col("y.key")) & condition)
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _indexed(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The prefix index of the nodes: ``key`` (a shingle), ``nodes`` that hold it, ``node``,
    ``n``, ``rare`` and the shingle's ``rank`` in its set.

    Shingles are in the order of how many nodes hold them. Two sets that are similar enough
    share one of the first ``n - ceil(share * n) + 1`` of either, for one the first that they
    share at all. Is it not rare, they share no rare one, and the ``rare`` shingles
    of both are in no intersection and in every union: a bound that leaves out
    what has too many of them.
    """

    def numbers(found: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(f, "<i8") for f in found], dtype=object)

    listed = F.pandas_udf(numbers, "array<bigint>")(F.col("shingles"))
    each = stage_rows(
        sets.join(nodes, "node").select("node", "n", F.explode(listed).alias("key")), "shingles"
    )
    spread = each.groupBy("key").agg(F.count(F.lit(1)).alias("nodes"))
    counted = stage_rows(_with_key_facts(each, spread), "counted")
    rare = counted.groupBy("node").agg(F.count_if(F.col("nodes") <= RARE).alias("rare"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("nodes", "key"))
    ranked = counted.withColumn("rank", rank).join(rare, "node")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    few = percent * F.col("rare") <= (100 - percent) * (F.col("n") - F.col("rare"))
    useful = (F.col("nodes") > 1) & ((F.col("nodes") <= RARE) | few)
    kept = ranked.where((F.col("rank") <= prefix) & useful)
    return stage_rows(kept.select("key", "nodes", "node", "n", "rare", "rank"), "index")


def near_duplicates(df: DataFrame, doc_id: str, text: str, percent: int = 85) -> DataFrame:
    """Per row of ``df``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked where ``100 * intersection >= percent * union`` of their
    sets of five-word shingles; ``component_id`` is the smallest id reachable
    over links. A NULL or empty text, and one without words, is linked with nothing.
    A NULL id takes part in no link, has no component and is kept. Repeated rows
    of an id are one document; rows of one id with different texts each follow
    their own text. Other columns are left out.
    """
    return _judge(df, doc_id, text, percent).select(
        F.col("id").alias(doc_id), "n_shingles", "component_id", "kept"
    )


def _judge(df: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """The same with ``id`` and ``version``, which tells texts of an id apart; a staged table."""
    spark = df.sparkSession
    outlives = staging_path(spark, "near-duplicates")
    rows = df.select(column(doc_id).alias("id"), column(text).cast("string").alias("text"))
    made = text_column(
        F.col("text"),
        "n_shingles long, digest binary, keys array<bigint>, places binary",
        partial(_sketches, *bands_and_rows(percent)),
    )
    with scratch(spark):
        sketches = rows.select("id", _version(F.col("text")).alias("version"), made.alias("s"))
        sketches = stage_rows(sketches.select("id", "version", "s.*"), "sketches")
        whole = sketches.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
        classes = stage_rows(
            whole.groupBy("digest").agg(
                F.min("id").alias("node"),
                F.first("n_shingles").alias("n"),
                F.first("keys").alias("keys"),
                F.first("places").alias("places"),
            ),
            "classes",
        )
        links = _link(rows, classes, percent)
        names = links.with_component(classes.select("digest", "node"), "node").select("digest", "component")
        found = sketches.select("id", "version", "n_shingles", "digest").join(names, "digest", "left")
        component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component"))
        component = F.when(F.col("id").isNotNull(), component)
        judged = found.select(
            "id",
            "version",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
        return stage_rows(judged, path=outlives)


def _version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _link(rows: DataFrame, classes: DataFrame, percent: int) -> Links:
    bands = classes.select("node", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader"))
    members = stage_rows(
        _with_key_facts(bands, shared.where("size > 1")).select("key", "node", "leader"), "buckets"
    )
    # the sets of all that share a bucket, from their whole texts
    wanted = members.select("node").distinct().join(classes.drop("keys"), "node")
    read = rows.join(wanted, F.col("id") == F.col("node"))
    made = _set(F.col("text"), F.col("digest")).alias("shingles")
    own = read.select("node", "digest", "n", "places", made).where("shingles IS NOT NULL")
    sets = stage_rows(
        own.groupBy("node", "digest").agg(
            *[F.first(c).alias(c) for c in ("n", "places", "shingles")]
        ),
        "sets",
    )
    links = Links(sets, percent)
    links.verify(members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    mixed = stage_rows(links.mixed(members), "mixed")
    apart = F.col("x.component") < F.col("y.component")
    unseen = (F.col("x.node") != F.col("x.leader")) & (F.col("y.node") != F.col("y.leader"))
    links.verify(_across(mixed.where(F.col("size") <= SMALL_BUCKET), apart & unseen))
    large = mixed.where(F.col("size") > SMALL_BUCKET).select("node").distinct()
    if large.isEmpty():
        return links
    index = _indexed(large, sets, percent)
    # the member with the fewest rare shingles is likely to be near all others; a pair that
    # is lost to the estimate here is among those below
    middle = index.groupBy("key").agg(F.min(F.struct("rare", "node")).alias("m"))
    stars = _with_key_facts(index, middle.select("key", F.col("m.node").alias("b")))
    links.verify(stars.where("node <> b").select(F.col("node").alias("a"), "b").distinct())
    rest = stage_rows(links.mixed(index), "rest")
    x_n, y_n = F.col("x.n"), F.col("y.n")
    sized = 100 * F.least(x_n, y_n) >= percent * F.greatest(x_n, y_n)
    in_common = F.least(x_n - F.col("x.rare"), y_n - F.col("y.rare"))
    enough = (100 + percent) * in_common >= percent * (x_n + y_n)
    # The first shingle that two sets share has no other before it in either, which bounds what they
    # share. Later ones may fail the same test, as their pair was met at the first.
    left = F.least(x_n - F.col("x.rank"), y_n - F.col("y.rank")) + 1
    sized = sized & ((100 + percent) * left >= percent * (x_n + y_n))
    pairs = _across(rest, apart & sized & ((F.col("x.nodes") <= RARE) | enough))
    links.verify(pairs, estimate=False)
    return links


def keep_one(df: DataFrame, doc_id: str, text: str, percent: int = 80) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, one document of each component.

    Rows with a NULL id, a NULL or empty text or one without words are kept. Repeated rows of an
    id stay or go together; of rows of one id with different texts each follows its own.
    All columns are kept.
    """
    judged = _judge(df, doc_id, text, percent).where("NOT kept")
    own = [free_name(df, "__gone"), free_name(df, "__text")]
    gone = judged.select(F.col("id").alias(own[0]), F.col("version").alias(own[1])).distinct()
    same = (column(doc_id) == gone[own[0]]) & (_version(column(text)) == gone[own[1]])
    return df.join(gone, same, "left_anti")
