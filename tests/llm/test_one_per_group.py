"""Exactly one row of each SimHash group stays, whatever ids and texts repeat."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillmark.llm import simhash

LONG = " ".join(f"word{n}" for n in range(200))


def kept(spark, rows, schema="doc_id long, text string, fingerprint int, Digest string"):
    df = spark.createDataFrame([(*row, 1, "d") for row in rows], schema).repartition(3)
    got = simhash.one_per_group(df)
    assert got.columns == df.columns
    return Counter((row.doc_id, row.text) for row in got.collect())


@pytest.mark.parametrize(
    ("rows", "stay"),
    [
        ([(None, "a b c d e"), (1, "a b c d e"), (None, LONG)], [(1, "a b c d e"), (None, LONG)]),
        ([(2, "one two three four"), (2, LONG)], [(2, "one two three four"), (2, LONG)]),
        ([(5, LONG), (3, LONG), (4, LONG), (3, LONG)], [(3, LONG)]),
        ([(None, LONG), (None, LONG)], [(None, LONG)]),
        ([(7, None), (8, ""), (9, " ")], [(7, None)]),
        ([(7, ""), (7, None), (7, None)], [(7, "")]),
        ([], []),
    ],
)
def test_rows(spark, rows, stay):
    assert kept(spark, rows) == Counter(stay)


def test_whole_table(spark):
    """One row per component, the one whose id names it."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    groups = {row.component_id for row in simhash.simhash_groups(documents).collect()}
    got = [row.doc_id for row in simhash.one_per_group(documents).collect()]
    assert sorted(got) == sorted(groups) and len(got) < documents.count()


def test_a_root_of_half_of_all_fingerprints(spark):
    """A chain of fingerprints one bit apart is one group however its nodes are dealt."""
    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("same words every time here")).otherwise(F.concat(F.lit("other "), F.col("id"), F.lit(" words"))).alias("text"))
    found = {row.doc_id: row.component_id for row in simhash.simhash_groups(texts).collect()}
    assert all(found[n] == 0 for n in range(0, 400, 2)) and len(found) == 400
