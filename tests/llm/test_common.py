"""Session settings of the text operators, first rows of groups."""

from collections import Counter

import pytest

from tillmark.llm import common

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize(("given", "after"), [("64m", "4000000"), ("1k", "1k"), ("2mb", "2mb"), ("3000b", "3000b")])
def test_batch_sizes(spark, given, after):
    before = spark.conf.get(SETTING)
    try:
        spark.conf.set(SETTING, given)
        common.small_batches(spark)
        assert spark.conf.get(SETTING).removesuffix("b") in (after, after.removesuffix("b"))
    finally:
        spark.conf.set(SETTING, before)


def test_first_places(spark):
    """The same rows and places as one sort a group, with a hot group, ties and null groups."""
    rows = [("hot", n * 7919 % 1000, n) for n in range(2_000)] + [(None, n % 5, n) for n in range(9)] + [("one", 1, 1)]
    df = spark.createDataFrame(rows, "_slice string, mixed int, n int").repartition(7)
    got = common.first_places(df, ["_slice"], ["mixed", "n"], 40, "place")
    assert got.columns == ["_slice", "mixed", "n", "place"]
    want = set()
    for group in ("hot", None, "one"):
        own = sorted((mixed, n) for name, mixed, n in rows if name == group)
        want |= {(group, *row, place) for place, row in enumerate(own[:40], 1)}
    assert len(want) == 50 and Counter(map(tuple, got.collect())) == Counter(want)
    assert common.first_places(df.where("false"), ["_slice"], ["mixed"], 3, "place").collect() == []
