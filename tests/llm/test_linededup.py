import re

import duckdb
from pyspark.sql import functions as F

from stratalift.llm import linededup, queries

LONG = "The very same Line of more than forty Characters, again and again"


def plainly(rows, least_chars=40, least_docs=5):
    """(n_lines, n_dropped, kept text) per row, by the contract's words."""
    docs, split = {}, []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\v\f\r")) for x in lines]
        split.append((doc, lines, keys))
        for key in keys:
            if doc is not None and len(key) >= least_chars:
                docs.setdefault(key, set()).add(doc)
    out = []
    for doc, lines, keys in split:
        gone = [
            doc is not None and len(docs.get(k, ())) >= least_docs and doc != max(docs[k]) for k in keys
        ]
        out.append((len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return out


def rows_of_all_kinds():
    rows = [(k, f"{LONG}\nline {k} of its own with more than forty characters\n\n  {LONG.upper()}\t\r\nend") for k in range(9)]
    rows += [(20 + k, f"x\nÉCOLE {LONG}\n" * 3) for k in range(4)] + [(30, f"École {LONG}"), (31, f"éCOLE {LONG}")]
    rows += [(40 + k, "\n".join([f"{LONG} {n % 70}" for n in range(200)])) for k in range(6)]
    rows += [(50, None), (51, ""), (52, "\n"), (None, LONG), (None, None), (8, f"{LONG}\nanother version"), (3, rows[3][1])]
    rows += [(60 + k, "forty characters and not one letter less" if k < 5 else LONG) for k in range(7)]
    rows += [(70 + k, "thirty-nine characters, so it may stay!") for k in range(7)]
    rows += [(80, "\n".join(["word"] * 5000 + [LONG] + ["word"] * 100)), (81, "x" * 500_000)]
    return rows


def test_against_plain_python(spark):
    rows = rows_of_all_kinds()
    df = spark.createDataFrame(rows, "Id int, text string").withColumns({"N_Lines": F.lit("x"), "doc": F.lit(2)})
    found = linededup.drop_repeated_lines(df, "Id", "text")
    assert found.columns == ["Id", "text", "doc", "n_lines", "n_dropped", "kept_text"]
    got = sorted(((r["Id"], r["text"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found.collect()), key=repr)
    assert got == sorted(((*r, *p) for r, p in zip(rows, plainly(rows), strict=True)), key=repr)
    assert linededup.drop_repeated_lines(df.limit(0), "Id", "text").count() == 0
    few = linededup.drop_repeated_lines(df, "Id", "text", least_chars=1, least_docs=2)
    assert sorted(r["kept_text"] for r in few.collect()) == sorted(p[2] for p in plainly(rows, 1, 2))


def test_bitmaps_skip_words_that_all_stay(spark):
    text = "\n".join(["word"] * 200 + [LONG] + ["word"] * 300)
    df = spark.createDataFrame([(k, text if k else LONG) for k in range(6)], "id int, text string")
    maps = {r["doc"]: r for r in linededup.keep_bitmaps(df, "id", "text").collect()}
    assert maps.keys() == {0, 1, 2, 3, 4}
    assert [tuple(b) for b in maps[1]["bitmap"]] == [(3, ~(1 << 8))] and maps[1]["n_dropped"] == 1
    assert [tuple(b) for b in maps[0]["bitmap"]] == [(0, ~1)]


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = queries.op12_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_against_its_sql(spark, sf_dir, tmp_path):
    made = str(tmp_path / "made")
    rows = [r for r in rows_of_all_kinds() if r[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{made}/documents.parquet")
    for folder, files in ((sf_dir, "documents.parquet"), (made, "documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/{files}'")
        wanted = sorted(con.execute(queries.ORACLES["op12_line_dedup"]).fetchall())
        assert sorted(tuple(r) for r in queries.op12_line_dedup(spark, folder).collect()) == wanted
