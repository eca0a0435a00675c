"""Each query against its brute-force version, on odd and on the smallest given rows."""

import brute
import pytest
import tiktoken

from quillon.llm import bpe, html_text, registry
from quillon.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["odd", "small"])
def given(request, spark, folder):
    at = folder if request.param == "odd" else SF
    return at, pairs(spark.read.parquet(f"{at}/documents.parquet"))


def test_op1(spark, given):
    at, docs = given
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()]
    got = rows(QUERIES["op1_decontaminate"](spark, at), ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert got == sorted(brute.op1(docs, items), key=repr)


def test_op2(spark, given):
    at, docs = given
    assert rows(QUERIES["op2_simhash"](spark, at), ["doc_id", "fingerprint", "component_id"]) == sorted(brute.op2(docs), key=repr)


def test_op3(spark, given):
    at, docs = given
    assert rows(QUERIES["op3_suffix_dedup"](spark, at), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == sorted(brute.op3(docs), key=repr)


def test_op6_base(spark, given):
    at, docs = given
    out = QUERIES["op6_line_quality"](spark, at)
    got = rows(out, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])
    assert got == sorted(brute.op6_base(docs), key=repr)
    assert out.filter("base_failed and kept").count() == 0


def test_op7(spark, given):
    at, docs = given
    path, pattern = bpe.default_vocabulary()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert rows(QUERIES["op7_bpe"](spark, at), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == sorted(brute.op7(docs, encoding), key=repr)


def test_op9(spark, given):
    at, docs = given
    assert rows(QUERIES["op9_line_dedup"](spark, at), ["doc_id", "n_lines", "n_dropped", "kept_sha256"]) == sorted(brute.op9(docs), key=repr)


def test_op4(spark, folder):
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in QUERIES["op4_html_text"](spark, folder).collect()}
    assert got[(1, "u")] == got[(2, None)] == ("", 0)
    assert got[(None, "u")][0] == "A title Some & more text, in the article. And another sentence."
    assert got[(3, "u")][1] == len(("Long text here, with words. " * 20000).strip())


def test_op5_op8_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = QUERIES["op5_quality_cnn"](spark, folder)
    assert out.count() == docs.count()
    assert out.filter("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int) or held_out is null").count() == 0
    assert out.filter("doc_id is not null and held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").count() == 0
    out = QUERIES["op8_language_id"](spark, folder)
    assert out.count() == docs.count()
    assert out.filter("held_out is null or score is null or score < 0 or score > 1").count() == 0
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert got[1] == got[2] == got[3] == got[10] == "und"


def test_op10(spark, folder):
    out = {}
    for r in QUERIES["op10_token_counts"](spark, folder).collect():
        out.setdefault(r.doc_id, r)
    path, pattern = bpe.default_vocabulary()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    docs = dict(pairs(spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id in (1, 7, 8, 9, 11)")))
    for i, t in docs.items():
        assert out[i].n_tokens == len(encoding.encode_ordinary(t or ""))
    r = out[11]
    assert r.n_edits == 2
    edited = docs[11].replace("some.one@example.org", "[EMAIL]").replace("+1 555 123 4567", "[NUMBER]")
    assert r.n_tokens_edited == len(encoding.encode_ordinary(edited))
    assert r.n_encoded < 30


def test_empty_tables(spark, empty_folder):
    for name, query in QUERIES.items():
        assert query(spark, empty_folder).collect() == [], name


def test_extra_columns_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>Some text, in a paragraph.</p></article>", "x")], "page_id long, url string, html string, text string")
    row = html_text.extract(pages).first()
    assert row["text"] == "x" and row["_text"] == "Some text, in a paragraph."


def test_sql_names():
    assert set(registry.SQL) <= set(registry.QUERIES)
