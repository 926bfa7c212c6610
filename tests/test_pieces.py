"""The daily fact of a stream: whole rows travel once, whatever share of them one key holds."""

import random

import pytest
from pyspark.sql import functions as F

from test_narrow_rows import exchanges
from test_ordered import multiset
from test_parted import fact_rows
from test_plans import plan_of
from tillmark.operators.ordered import with_previous_value
from tillmark.operators.pieces import CARRIED, CUTS, cuts, with_value_before
from tillmark.plans import marts
from tillmark.session import tuned
from tillmark.sources.parted import PART, bucket
from tillmark.streaming import daily

SCHEMA = "k string, day int, price double, wide string"
ORDER = ["k", "day", "price"]


def in_parts(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.withColumn(CARRIED, F.lit(False)).withColumn(PART, bucket(["k"], parts))


def looked_back(rows, found):
    parts = [row[0] for row in rows.select(PART).distinct().collect()]
    return with_value_before(rows, found, parts, *ORDER, "was")


def test_whole_rows_travel_once(spark, tmp_path):
    rows = in_parts(spark, [(k, 1, 1.0, "x") for k in "abcdefgh"])
    cuts(rows, ORDER).write.parquet(f"{tmp_path}/cuts")
    found = exchanges(plan_of(looked_back(rows, spark.read.parquet(f"{tmp_path}/cuts"))))
    dealt = [how for columns, how in found if "wide#" in columns and "RoundRobin" not in how]  # round robin is the test's own
    assert len(dealt) == 1 and "passthrough" in dealt[0]


@pytest.mark.parametrize("piece_rows", [1, 4, 30, 10_000])
def test_values_before_across_pieces(spark, tmp_path, piece_rows):
    rng = random.Random(2)
    rows = [(None, rng.choice([None, *range(9)]), rng.choice([None, 0.0, 1.5, float("nan")]), rng.choice("xyz")) for _ in range(250)]
    rows += [(f"k{rng.randrange(20)}", rng.randrange(9), rng.choice([None, 1.0, 2.0]), rng.choice("xyz")) for _ in range(150)]
    rows += rows[:60]
    df = in_parts(spark, rows)
    cuts(df, ORDER, piece_rows).write.parquet(f"{tmp_path}/cuts")
    found = spark.read.parquet(f"{tmp_path}/cuts")
    n_cuts = found.select(F.sum(F.size(CUTS))).first()[0] or 0
    assert n_cuts > 40 if piece_rows == 1 else n_cuts == 0 if piece_rows == 10_000 else n_cuts > 5
    got = looked_back(df, found).select(*ORDER, "wide", "was")
    want = with_previous_value(spark.createDataFrame(rows, SCHEMA), *ORDER, "was").select(*ORDER, "wide", "was")
    assert multiset(got.withColumns({n: F.col(n).cast("string") for n in ("price", "was")})) == multiset(
        want.withColumns({n: F.col(n).cast("string") for n in ("price", "was")})
    )


def test_a_hot_key_is_dealt_to_several_tasks(spark, tmp_path):
    df = in_parts(spark, [(None, n % 50, float(n % 7), str(n)) for n in range(1000)])
    cuts(df, ORDER, 50).write.parquet(f"{tmp_path}/cuts")
    got = looked_back(df, spark.read.parquet(f"{tmp_path}/cuts"))
    sizes = [row[1] for row in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 15 and max(sizes) <= 60


def test_carried_rows_are_looked_back_to_and_go(spark, tmp_path):
    fresh = in_parts(spark, [("a", 5, 2.0, "x"), ("b", 5, 3.0, "x"), (None, None, 1.0, "x"), (None, 5, 4.0, "x")])
    last = in_parts(spark, [("a", 1, 9.0, None), ("c", 1, 8.0, None)]).drop("wide").withColumn(CARRIED, F.lit(True))
    rows = fresh.unionByName(last, allowMissingColumns=True)
    for piece_rows in (1, 100):
        cuts(rows, ORDER, piece_rows).write.parquet(f"{tmp_path}/{piece_rows}")
        got = looked_back(rows, spark.read.parquet(f"{tmp_path}/{piece_rows}"))
        assert sorted((r.k or "", r.day or 0, r.was) for r in got.collect()) == [("", 0, None), ("", 5, 1.0), ("a", 5, 9.0), ("b", 5, None)]


@pytest.mark.parametrize("ordered", [True, False])
def test_daily_fact_in_small_pieces_equals_batch(spark, tmp_path, ordered):
    rows, schema = fact_rows(spark, 4)
    place = schema.names.index("snapshot_date")
    if ordered:
        rows.sort(key=lambda row: (row[place] is not None, row[place]))
    for part in (0, 1, 1):
        batch = spark.createDataFrame(rows[part * 315 : (part + 1) * 315], schema)
        daily.bring_up_to_date(batch, f"{tmp_path}/d", part, buckets=2, piece_rows=7)
    want = marts.fact_price_daily(spark.createDataFrame(rows, schema))
    assert multiset(daily.current(spark, f"{tmp_path}/d", schema)) == multiset(want)


def test_a_batch_without_trusted_rows(spark, tmp_path):
    rows, schema = fact_rows(spark, 4)
    batch = spark.createDataFrame(rows, schema)
    daily.bring_up_to_date(batch.where("is_quarantined"), f"{tmp_path}/d", 0, buckets=2)
    assert daily.current(spark, f"{tmp_path}/d", schema).count() == 0
    daily.bring_up_to_date(batch, f"{tmp_path}/d", 1, buckets=2)
    assert multiset(daily.current(spark, f"{tmp_path}/d", schema)) == multiset(marts.fact_price_daily(batch))


def test_few_parts_are_written_without_a_sort(spark):
    """Sorting whole rows by part before the write spilled them on large inputs."""
    assert int(tuned(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
