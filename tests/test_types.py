"""Types found from text, merged over files and batches, and cells that do not fit them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillmark.sources import types


@pytest.mark.parametrize(
    ("cells", "kind"),
    [
        (["", None, " "], "string"), (["true", "False", ""], "boolean"), (["1", " -2 ", "+3"], "int"),
        (["1", "2147483648"], "bigint"), (["9" * 19], "double"), (["1", "99999999999", ".5", "1.", "2e3"], "double"),
        (["2021-04-23"], "date"), (["2021-02-30"], "string"), (["2021-04-23", "2021-04-23 10:00:00", "2021-04-23T10:00"], "timestamp"),
        (["1", "true"], "string"), (["2021-04-23", "5"], "string"), (["$1"], "string"), (["1", "n/a"], "string"), (["NaN"], "string"),
    ],
)
def test_type_of_cells(spark, cells, kind):
    df = spark.createDataFrame([(cell,) for cell in cells], "`a b` string").repartition(3)
    (row,) = types.merged_types(types.type_masks(df, ["a b"])).collect()
    assert (row.column, row.type) == ("a b", kind)


def test_batches_add_up_and_repeat(spark, tmp_path):
    def rows(*cells):
        return spark.createDataFrame([(cell, "x", f"f{n}") for n, cell in enumerate(cells)], "a string, b string, _source_file string")

    path = f"{tmp_path}/types"
    for number, batch in ((0, rows("1", "2")), (1, rows("3.5", "")), (1, rows("3.5", ""))):
        types.learn(batch, ["a", "b"], path, number)
    assert types.learned(spark, path) == {"a": "double", "b": "string"}
    types.learn(rows("soon"), ["a", "b"], path, 2)
    assert types.learned(spark, path) == {"a": "string", "b": "string"}


def test_misfits_are_rescued(spark):
    raw = spark.createDataFrame(
        [("1", "2021-04-23", "t", None), ("1.5", "x", "t", '{"Colour":"red"}'), ("", None, "t", None)], "n string, d string, t string, _rescued_data string"
    )
    got = types.typed(raw, {"n": "int", "d": "date", "t": "string", "missing": "int"})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, dt.date(2021, 4, 23), "t", None), (None, None, "t", '{"Colour":"red","n":"1.5","d":"x"}'), (None, None, "t", None)], key=str
    )
    assert types.typed(raw.drop("_rescued_data"), {"n": "int"}).where(F.col("_rescued_data").isNotNull()).count() == 1
