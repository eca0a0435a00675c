import random

import pytest

#: Names that operators use for their own columns: they must not get in the way.
CLASHING = "n_words string, hit_spans string, hit_items string, row_key string, fp string, component_id string, kept_lines string, n_lines string, drop_words string, lang_pred string, kept string, n_tokens string, chunk string, bucket string, edits_ string"
COLUMNS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, ties."""
    r = random.Random(1)
    words = ["the", "of", "Über", "señor", "and", "that", "ring", "blue", "là", "zu", "with"]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = "This line is shared by several documents."
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t\n "),
        (4, prose(60) + "\n" + shared),
        (4, prose(30)),
        (5, shared + "\n" + prose(70) + "\n  " + shared.upper() + " "),
        (6, prose(5) + "\r\n" + shared + "\nend"),
        (6, prose(5) + "\r\n" + shared + "\nend"),
        (None, prose(40) + "\n" + shared),
        (None, None),
        (7, prose(30_000)),
        (8, "漢字 🙂 " * 30),
        (9, "a" * 5000),
        (10, "!!! ### 123"),
        (-3, prose(20)),
        (11, "mail me at some.one@example.org or +1 555 123 4567 now, " + prose(30)),
    ]
    base = prose(80)
    rows += [(20 + i, base) for i in range(4)] + [(30 + i, base + " " + w) for i, w in enumerate(["more", "words", "here"])]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    n = COLUMNS.count(",") + 1
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "s", None if t is None else len(t), *["x"] * (n - 5)) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def folder(spark, odd_docs, tmp_path_factory):
    """A data folder of the odd documents, with labels, a benchmark and pages."""
    at = tmp_path_factory.mktemp("odd")
    odd_docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, "the of and that ring blue the of and that ring"), (2, "blue ring"), (None, "zu zu"), (4, None), (5, " ?! ")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<html><body><nav><a href=x>Home</a></nav><article><h1>A title</h1><p>Some &amp; more text, in the\n article. And another sentence.</p></article>"), (3, "u", "<p>" + "Long text here, with words. " * 20000)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    return str(at)


@pytest.fixture(scope="session")
def empty_folder(spark, no_docs, tmp_path_factory):
    at = tmp_path_factory.mktemp("empty")
    no_docs.write.parquet(f"{at}/documents.parquet")
    for name, kind in (("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], kind).write.parquet(f"{at}/{name}.parquet")
    return str(at)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
