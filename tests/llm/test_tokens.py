import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalift.llm import packing, queries, simple8b, tokenfiles, tokens
from stratalift.llm.tokens import Encoder, encoder, tokenizer_content

CONTENT = tokenizer_content(queries.word_tokenizer())
ODD = [
    "It's HE'S we'd ÀÉÎ straße µª² ½ 12ab <|endoftext|> <|start", "\x85a\xa0b\x1cc", "é İ Σας ΣΑΣ",
    "", " \t\n", "a" * 5000, "!!! ***the$$$ don''t 'Ve", "日本語 😀 a​b", "ÿÝþÞ÷×¿¡",
]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(CONTENT)


def test_encoder_on_documents(spark, sf_dir, library):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in texts + ODD:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert encoder(CONTENT)(text).tolist() == wanted
    ids, counts = encoder(CONTENT).many([*texts, None, *ODD])
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in [*texts, None, *ODD]]
    assert ids.tolist() == [i for w in wanted for i in w]
    assert counts.tolist() == [len(w) for w in wanted]
    assert encoder(CONTENT).many([])[0].tolist() == []


def test_words_that_come_again_are_coded_once(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 40)
    monkeypatch.setattr(tokens, "SLICE_CHARS", 1)
    alone, coded = Encoder(CONTENT), []
    code = alone.words.code
    alone.words.code = lambda word: coded.append(word) or code(word)
    texts = [f"Often, ÉTÉ {' '.join(chr(97 + k) * n for k in range(15))}" for n in range(1, 30)]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    ids, counts = alone.many(texts)
    assert ids.tolist() == [i for w in wanted for i in w] and counts.tolist() == [len(w) for w in wanted]
    assert coded.count("often") == coded.count(",") == 1 and len(coded) == 29 * 15 + 3
    assert len(alone.words) + len(alone.words.older) < 40 + 2 * 18


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x17F, exclude_categories=["Cs"])))
def test_encoder_on_any_text(text):
    e = encoder(CONTENT)
    wanted = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert e(text).tolist() == wanted == e.many([text])[0].tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1))), st.data())
def test_simple8b_round_trip(values, data):
    words, escapes = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, escapes, len(values)).tolist() == values
    before = simple8b.offsets(words, 4)
    if values:
        start = data.draw(st.integers(0, len(values) - 1))
        n = data.draw(st.integers(1, len(values) - start))
        assert simple8b.decode_range(words, escapes, before, 4, start, n).tolist() == values[start : start + n]


def test_simple8b_packs():
    words, escapes = simple8b.encode(np.array([1, 0] * 30 + [2**60] + [5000] * 4))
    assert len(words) == 3 and escapes.tolist() == [2**60]


def test_files(spark, tmp_path, library):
    rows = [(5, "b c"), (None, "x"), (1, None), (1, ""), (3, "w " * 30000), (5, "b c")]
    df = spark.createDataFrame(rows, "doc_id int, body string").withColumnRenamed("body", "ids")
    path = str(tmp_path / "f")
    tokenfiles.write_token_files(df, path, "doc_id", "ids", queries.word_tokenizer(), 2, block_ids=4)
    out = sorted(tokenfiles.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == [None, 1, 1, 3, 5, 5]
    at = 0
    for r in out:
        text = next(t or "" for d, t in rows if d == r["doc_id"])
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)
    tokenfiles.write_token_files(df.limit(0), path, "doc_id", "ids", queries.word_tokenizer(), 2)
    assert tokenfiles.read_token_files(spark, path).collect() == []


def test_op10(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in queries.op10_token_files(spark, sf_dir).collect()}
    at = 0
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids + [2]
        r = got.pop(d["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


def placed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_sum_of_squares(lengths):
    sequence, offset = packing.sum_of_squares(np.array(lengths, np.int64), 20)
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(sequence, offset, lengths) if n]
    used = placed(rows, 20)
    assert sum(lengths) <= 20 * used or not used
    assert used <= 1 + 2 * sum(lengths) // 20


def test_sum_of_squares_too_long():
    with pytest.raises(ValueError):
        packing.sum_of_squares(np.array([5]), 4)


def test_op7(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    out = queries.op7_packing(spark, sf_dir).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
    total = 0
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids + [1]
        total += len(ids)
        for k, r in enumerate(sorted(by_doc.pop(d["doc_id"]), key=lambda r: r["piece"])):
            own = ids[k * 4096 : k * 4096 + 4096]
            assert (r["piece"], r["start"], r["length"]) == (k, k * 4096, len(own))
            assert r["ids_crc32"] == crc(own)
        assert (k + 1) * 4096 >= len(ids)
    assert not by_doc
    assert placed(out, 4096) <= -(-total // 4096) * 1.02 + 1


def test_packing_nulls_repeats_and_clashes(spark):
    rows = [(None, 3), ("a", None), ("a", 3), ("a", 3), ("a", -1)]
    df = spark.createDataFrame(rows, "Offset string, n int")
    out = packing.pack_rows(df.withColumn("__group", df.n), "n", 6).collect()
    assert len(out) == 5 and set(out[0].asDict()) == {"n", "__group", "sequence_id", "offset"}
    assert placed([{**r.asDict(), "length": r["n"]} for r in out if (r["n"] or 0) > 0], 6) == 2
    assert packing.pack_rows(df.limit(0), "n", 6).collect() == []
    odd = spark.createDataFrame([(None, None), (7, ""), (7, "")], "doc_id long, text string")
    cut = packing.cut_documents(odd, "doc_id", "text", queries.word_tokenizer(), 1, 4096).collect()
    assert [(r["doc_id"], r["length"]) for r in cut] == [(None, 1), (7, 1), (7, 1)]
