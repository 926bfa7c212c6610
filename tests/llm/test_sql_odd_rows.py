"""The queries that have SQL, on null, empty, odd and repeated rows with clashing columns."""

import os

import pytest

from oracle import TABLES, compare
from tillmark.llm import queries

SF = "/root/testdata/sf0.001"
URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?q#f", "http://x.com/fr/1", "http://x.com/de/1", "ftp://h#f", "http://h?x",
    "http://example.org/en/12", "http://sub.example.org/en/1/2", "http://org/", "http://a.b.co.uk/p", "x://y://z/w", "HTTP://COM/FR/",
]


def folder(spark, tmp_path, **tables):
    for name in TABLES:
        place = f"{tmp_path}/{name}.parquet"
        if name in tables:
            tables[name].coalesce(1).write.parquet(f"{tmp_path}/{name}.dir")
            (part,) = [one for one in os.listdir(f"{tmp_path}/{name}.dir") if one.endswith(".parquet")]
            os.symlink(f"{tmp_path}/{name}.dir/{part}", place)
        else:
            os.symlink(f"{SF}/{name}.parquet", place)
    return str(tmp_path)


@pytest.mark.parametrize("empty", [False, True])
def test_urls(spark, tmp_path, empty):
    rows = [(n, url, "<p>x</p>", "h", "p", "r") for n, url in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, Path string, rule string")
    pages = pages.where("false") if empty else pages
    sf_dir = folder(spark, tmp_path, pages=pages)
    _, problems = compare(spark, sf_dir, queries.QUERIES["op9_url_filter"], queries.SQL["op9_url_filter"])
    assert not problems


@pytest.mark.parametrize("empty", [False, True])
def test_conversations(spark, tmp_path, empty):
    def turns(key, *texts):
        return [(key, turn, ("user", "assistant")[turn % 2], text, "m", "c") for turn, text in enumerate(texts)]

    rows = turns(1, "hi", "a", "b", "c") + turns(2, "hi", "a", "x", "d") + turns(3, "hi", None, "") + turns(4, None) + turns(5, "hi", "a", "b", "c")
    rows += turns(6, "") + turns(7, "hi", "z" * 5_000) + turns(None, "hi", "a")
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string, Chosen string")
    talks = talks.where("false") if empty else talks
    sf_dir = folder(spark, tmp_path, conversations=talks)
    _, problems = compare(spark, sf_dir, queries.QUERIES["op10_preferences"], queries.SQL["op10_preferences"])
    assert not problems


@pytest.mark.parametrize("empty", [False, True])
def test_collocations(spark, tmp_path, empty):
    texts = [None, "", " ", "a b c " * 40, "A b. c d, e f! " * 30, "é ü É\tx " * 20, "a b c " * 40]
    rows = [(n, text, lang, "s", 1, 7) for n, text in enumerate(texts) for lang in ("en", None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    docs = docs.where("false") if empty else docs
    sf_dir = folder(spark, tmp_path, documents=docs)
    _, problems = compare(spark, sf_dir, queries.QUERIES["op12_collocations"], queries.SQL["op12_collocations"])
    assert not problems
