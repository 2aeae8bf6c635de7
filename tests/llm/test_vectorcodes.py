import hashlib
import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalift.llm import queries, vectorcodes
from stratalift.llm.gnat import Search


def plainly(points, entries):
    """Index and squared distance of the nearest entry, in Python integers."""
    found = []
    for p in points.tolist():
        d, k = min((sum((a - b) ** 2 for a, b in zip(p, e, strict=True)), k) for k, e in enumerate(entries.tolist()))
        found.append((k, d))
    return found


@settings(max_examples=60, deadline=None)
@given(
    st.integers(1, 40), st.integers(1, 4), st.sampled_from([1, 3, 50, 10**8]), st.integers(0, 10**6), st.integers(2, 6)
)
def test_search_is_the_nearest_entry(n, width, spread, seed, degree):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (n, width))  # small spreads repeat entries and tie
    points = np.concatenate([rng.integers(-spread, spread + 1, (60, width)), entries])
    index, distance = Search(entries, degree).nearest(points)
    assert list(zip(index.tolist(), distance.tolist(), strict=True)) == plainly(points, entries)


def test_subtrees_are_ruled_out():
    rng = np.random.default_rng(1)
    entries = rng.integers(-40, 40, (256, 4)) + 4000 * rng.integers(0, 8, (256, 1))
    search = Search(entries)
    search.nearest(entries)
    assert search.compared < 0.35 * 256 * len(entries)


def compress(rows, parts=8, entries=16, rounds=6):
    """The whole contract on Python numbers: code, error and digest by position in ``rows``."""
    numbers = {
        at: [math.floor(4096 * x) for x in v]
        for at, (_, v, *_) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    width = len(next(iter(numbers.values()))) // parts
    cut = {at: [v[k * width : (k + 1) * width] for k in range(parts)] for at, v in numbers.items()}
    first = sorted((rows[at][0], at) for at in cut if rows[at][0] is not None)[:entries]
    books = [[cut[at][k] for _, at in first] for k in range(parts)]

    def near(part, k):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[k]))

    for _ in range(rounds):
        groups = {}
        for v in cut.values():
            for k in range(parts):
                groups.setdefault((k, near(v[k], k)[1]), []).append(v[k])
        for (k, i), held in groups.items():
            books[k][i] = [sum(c) // len(held) for c in zip(*held, strict=True)]
    out = {}
    for at, v in cut.items():
        best = [near(v[k], k) for k in range(parts)]
        out[at] = ("".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best))
    every = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(every.encode()).hexdigest()


def table_of(seed, n):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(k % 5, 1.0) for _ in range(16)], k % 4 or None) for k in range(n, 0, -1)]
    rows += [(n + 1, None, 1), (n + 2, [None] + [1.0] * 15, 1), (n + 3, [math.nan] * 16, 2), (-1, [math.inf] * 16, 3)]
    rows += [(n + 4, rows[0][1], 1), (n + 5, rows[0][1], 1), (None, [0.5] * 16, None)]
    return rows


def test_query_against_plain_numbers(spark, tmp_path):
    for n in (3, 150):
        rows = table_of(n, n)
        folder = str(tmp_path / f"{n}")
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(
            f"{folder}/embeddings.parquet"
        )
        expected, digest = compress(rows)
        labels = {}
        for at, (_, error) in expected.items():
            labels[rows[at][2]] = labels.get(rows[at][2], 0) + error
        wanted = sorted((str(rows[at][0]), *got, labels[rows[at][2]], digest) for at, got in expected.items())
        out = queries.op13_vector_codes(spark, folder)
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == wanted


def test_edges(spark):
    df = spark.createDataFrame(table_of(9, 40), "ID long, v array<double>, label int")
    df = df.withColumns({"Code": F.lit("x"), "extra": F.lit(1)})
    books = vectorcodes.fit_codebooks(df, "ID", "v", entries=4, rounds=2)
    out = vectorcodes.encode(df, "v", books)
    assert out.columns == ["ID", "v", "label", "extra", "code", "error"] and out.count() == 43
    # another dimension is left out, one that the parts do not divide is filled up
    odd = df.select("ID", F.slice("v", 1, 13).alias("v")).unionByName(df.select("ID", F.slice("v", 1, 5).alias("v")))
    odd = odd.where("ID <> 41 or ID is null")
    some = vectorcodes.fit_codebooks(odd.where("size(v) = 13"), "ID", "v", rounds=1)
    assert some.dimension == 13 and some.entries[0].shape[1] == 2
    assert vectorcodes.encode(odd, "v", some).count() == 43
    empty = df.limit(0)
    assert vectorcodes.fit_codebooks(empty, "ID", "v") is None
    assert vectorcodes.encode(empty, "v", None).columns == out.columns
    huge = spark.createDataFrame([(1, [1e308] * 8), (2, [-1e308] * 8)], "ID long, v array<double>")
    books = vectorcodes.fit_codebooks(huge, "ID", "v")
    assert {r["error"] for r in vectorcodes.encode(huge, "v", books).collect()} == {0}


def test_query_against_its_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    wanted = sorted(con.execute(queries.ORACLES["op13_vector_codes"]).fetchall())
    found = queries.op13_vector_codes(spark, sf_dir)
    assert sorted(tuple(r) for r in found.collect()) == wanted
