"""The pipeline's rows against its stages done one by one, and its stages on odd rows."""

import functools

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_brute_force import fingerprint, grouped
from tillmark.llm import decontaminate, pii, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture
def quick(monkeypatch):
    """Trains the network for fewer rounds, once per sample."""
    trained = pii.trained
    short = functools.cache(lambda texts: trained(list(texts), windows_kept=400, rounds=2))
    monkeypatch.setattr(pii, "trained", lambda texts: short(tuple(texts)))


def words(text):
    low = "".join(chr(ord(one) + 32) if "A" <= one <= "Z" else one for one in text or "")
    kept = "".join(one if one.isascii() and (one.isdigit() or one.islower()) or not one.isascii() else " " for one in low)
    return kept.split(" ")


def contaminated(text, windows):
    found = [word for word in words(text) if word]
    hit = set()
    for size in {len(window) for window in windows}:
        for at in range(len(found) - size + 1):
            if tuple(found[at : at + size]) in windows:
                hit.update(range(at, at + size))
    return len(hit) > 0 and 20 * len(hit) >= len(found)


def test_run_equals_its_stages(spark, quick):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("labels", "benchmark"))
    scored = {row.doc_id: row.predicted for row in quality.quality_scores(documents, labels).collect()}
    left = [row for row in documents.collect() if scored[row.doc_id] == 1]

    prints = {row.doc_id: fingerprint(row.text) for row in left}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = grouped(prints, links)
    left = [row for row in left if roots[row.doc_id] == row.doc_id]

    windows = set()
    for item in benchmark.collect():
        item_words = [word for word in words(item.text) if word]
        windows |= {tuple(item_words[at : at + 13]) for at in range(max(1, len(item_words) - 12))} - {()}
    left = [row for row in left if not contaminated(row.text, windows)]

    table = spark.createDataFrame(left, documents.schema)
    clean = corpus_pipeline.without_personal_data(spark, table, SF)
    assert clean.columns == documents.columns
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    want = {row.doc_id: library.encode(row.text or "", add_special_tokens=False).ids for row in clean.collect()}

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {row.doc_id: row.ids for row in rows} == want and len(rows) == len(want) > 50
    assert all(row.n_tokens == len(row.ids) for row in rows)


def test_stages_on_odd_rows(spark, quick):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x y " * 30_000, "en", "s", 120_000), (3, "tail a@b.cd 漢字", None, None, 14)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.where("false"), SF)
        assert empty.collect() == [], name
        done = stage(spark, docs, SF)
        assert done.count() <= len(rows), name
        if name != "encoding":
            assert done.columns == docs.columns and done.dtypes == docs.dtypes, name


def test_clean_only_and_removed_spans(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five"), (2, None), (3, "")], "item_id long, text string")
    rows = [(1, "A one, two three-four five b"), (2, "w " * 200 + "one two three four five"), (3, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    left = decontaminate.clean_only(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(row.doc_id for row in left.collect()) == [2, 3, 4, 4]
