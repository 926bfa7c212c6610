"""Tables kept up part by part: what is written, and that results equal the batch ones."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from test_ordered import DAY, multiset
from tillmark.operators.history import HistorySpec, scd2
from tillmark.plans import marts
from tillmark.plans.fact import FACT_SCHEMA
from tillmark.sources import parted
from tillmark.streaming import daily, history
from tillmark.streaming import marts as kept


def test_parts_replace_or_add(spark, tmp_path):
    schema, path = "part string, n int", f"{tmp_path}/t"

    def put(version, *rows):
        return parted.store(spark.createDataFrame(rows, schema), path, version, F.col("part"))

    def now(**how):
        return sorted(map(tuple, parted.read(spark, path, spark.createDataFrame([], schema).schema, **how).collect()))

    assert now() == []
    assert put(0, ("a", 1), ("b+", 2)) == ["a", "b+"]
    put(1, ("b+", 3))
    put(2, ("a", 4), ("a+", 5))
    assert now() == [("a", 4), ("a+", 5), ("b+", 2), ("b+", 3)]
    assert now(before=2) == [("a", 1), ("b+", 2), ("b+", 3)]
    assert now(only=["b", "missing"]) == [("b+", 2), ("b+", 3)]
    put(2, ("a", 6))  # a repeated batch
    assert now() == [("a", 6), ("b+", 2), ("b+", 3)]
    put(3)
    assert now() == [("a", 6), ("b+", 2), ("b+", 3)]
    put(4, ("a", 7))
    parted.tidy(spark, path, 4)
    assert now() == [("a", 7), ("b+", 2), ("b+", 3)] and now(before=4) == [("a", 6), ("b+", 2), ("b+", 3)]
    assert {p.parent.name for p in pathlib.Path(path).glob("v=*/_part=a")} == {"v=2", "v=4"}


def test_a_version_that_is_not_whole_does_not_count(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "part string, n int")
    parted.store(df, f"{tmp_path}/t", 0, F.col("part"))
    parted.store(df.withColumn("n", F.lit(2)), f"{tmp_path}/t", 1, F.col("part"))
    (tmp_path / "t/v=1/_SUCCESS").unlink()
    assert parted.read(spark, f"{tmp_path}/t", df.schema).first().n == 1


def folders(path, version):
    return {p.name.split("=", 1)[1] for p in pathlib.Path(path).glob(f"v={version}/_part=*")}


def test_history_writes_the_buckets_of_touched_keys_only(spark, tmp_path):
    spec = HistorySpec(keys=("k",), sequence="day", tracked=("a",))
    schema = "k string, day date, a string"
    many = [(f"k{n}", DAY + dt.timedelta(day), str(n + day)) for n in range(200) for day in range(3)]
    history.bring_up_to_date(spark.createDataFrame(many, schema), f"{tmp_path}/h", 0, spec, buckets=40)
    assert len(folders(f"{tmp_path}/h/versions", 0)) == 80
    forward = [("k1", DAY + dt.timedelta(9), "x"), ("k2", DAY + dt.timedelta(9), "y")]
    history.bring_up_to_date(spark.createDataFrame(forward, schema), f"{tmp_path}/h", 1, spec, buckets=40)
    touched = folders(f"{tmp_path}/h/versions", 1)
    assert len(touched) == 4 and all(name.endswith(("-open", "-closed+")) for name in touched)
    late = [("k3", DAY - dt.timedelta(1), "z"), (None, None, "n")]
    history.bring_up_to_date(spark.createDataFrame(late, schema), f"{tmp_path}/h", 2, spec, buckets=40)
    assert sum(name.endswith("-closed") for name in folders(f"{tmp_path}/h/versions", 2)) == 1
    everything = spark.createDataFrame(many + forward + late, schema)
    assert multiset(history.current(spark, f"{tmp_path}/h", everything.schema, spec)) == multiset(scd2(everything, spec))


def fact_rows(spark, seed, rows=600):
    pick = random.Random(seed)
    names = FACT_SCHEMA
    made = []
    for number in range(rows):
        product = pick.choice([None, None, "p1", *(f"q{n}" for n in range(12))])
        day = pick.choice([None, *(DAY + dt.timedelta(n) for n in range(9))])
        value = {
            "retailer": pick.choice(["Aldi", "Coles"]), "product_sk": product, "source_sku": str(number % 40),
            "price_aud": pick.choice([None, 0.0, 1.5, 2.0, 3.25]), "snapshot_date": day, "canonical_l1": pick.choice(["a", None]),
            "canonical_l2": "b", "norm_unit_price": pick.choice([None, 0.5, 1.2345, 7.0]), "norm_unit_measure": pick.choice(["per_kg", "per_l"]),
            "on_special": pick.choice([True, False, None]), "availability": pick.choice(["available", "unavailable", "unknown"]),
            "is_quarantined": pick.random() < 0.2, "_source_file": f"f{number % 7}",
        }
        made.append(tuple(value.get(name) for name in names.names))
    return made + made[:30], names


@pytest.mark.parametrize("ordered", [True, False])
def test_daily_fact_stream_equals_batch(spark, tmp_path, ordered):
    rows, schema = fact_rows(spark, 3)
    place = schema.names.index("snapshot_date")
    if ordered:
        rows.sort(key=lambda row: (row[place] is not None, row[place]))
    for part in (0, 1, 1):  # a repeated batch changes nothing
        daily.bring_up_to_date(spark.createDataFrame(rows[part * 315 : (part + 1) * 315], schema), f"{tmp_path}/d", part, buckets=2)
    want = marts.fact_price_daily(spark.createDataFrame(rows, schema))
    assert multiset(daily.current(spark, f"{tmp_path}/d", schema)) == multiset(want)


BATCH_MARTS = {
    "mart_price_comparison": lambda fact: marts.mart_price_comparison(marts.fact_price_daily(fact)),
    "mart_specials_penetration": lambda fact: marts.mart_specials_penetration(marts.fact_price_daily(fact)),
    "mart_category_price_index": lambda fact: marts.mart_category_price_index(marts.fact_price_daily(fact)),
    "mart_availability": marts.mart_availability,
    "mart_dq_scorecard": marts.mart_dq_scorecard,
}


@pytest.mark.parametrize("name", kept.KEPT_MARTS)
def test_mart_streams_equal_batch(spark, tmp_path, name):
    rows, schema = fact_rows(spark, 4, rows=300)
    mart = kept.KEPT_MARTS[name]
    for part in (0, 1, 1):  # a repeated batch changes nothing
        kept.bring_up_to_date(spark.createDataFrame(rows[part * 165 : (part + 1) * 165], schema), mart, f"{tmp_path}/m", part)
    got = kept.current(spark, mart, f"{tmp_path}/m", schema)
    want = BATCH_MARTS[name](spark.createDataFrame(rows, schema))
    assert multiset(got.select(*sorted(got.columns))) == multiset(want.select(*sorted(want.columns)))


def priced(spark, *rows):
    """Trusted fact rows: (day, retailer, unit price)."""
    schema = FACT_SCHEMA
    values = [
        {"snapshot_date": DAY + dt.timedelta(day), "retailer": retailer, "norm_unit_price": price, "is_quarantined": False}
        for day, retailer, price in rows
    ]
    return spark.createDataFrame([tuple(value.get(name) for name in schema.names) for value in values], schema)


def test_marts_write_touched_dates_only(spark, tmp_path):
    first = priced(spark, *[(day, "Aldi", 2.0) for day in range(5)])
    for name in ("mart_availability", "mart_price_comparison"):
        mart = kept.KEPT_MARTS[name]
        kept.bring_up_to_date(first, mart, f"{tmp_path}/{name}", 0)
        kept.bring_up_to_date(priced(spark, (3, "Aldi", 4.0), (7, "Coles", 4.0)), mart, f"{tmp_path}/{name}", 1)
        assert folders(f"{tmp_path}/{name}/rows", 1) == {"2021-04-26", "2021-04-30"}


def test_an_earlier_day_moves_the_base_of_its_group_only(spark, tmp_path):
    path, mart = f"{tmp_path}/m", kept.PRICE_INDEX
    kept.bring_up_to_date(priced(spark, (1, "Aldi", 2.0), (2, "Aldi", 3.0), (4, "Coles", 5.0)), mart, path, 0)
    kept.bring_up_to_date(priced(spark, (0, "Aldi", 4.0)), mart, path, 1)
    assert folders(f"{path}/rows", 1) == {"2021-04-23", "2021-04-24", "2021-04-25"}
    kept.bring_up_to_date(priced(spark, (0, "Aldi", 2.0)), mart, path, 2)  # the first day is completed: 3.0
    rows = kept.current(spark, mart, path, FACT_SCHEMA).collect()
    found = {(row.retailer, row.snapshot_date.day): (row.base_price, row.price_index) for row in rows}
    assert found == {("Aldi", 23): (3.0, 100.0), ("Aldi", 24): (3.0, 66.7), ("Aldi", 25): (3.0, 100.0), ("Coles", 27): (5.0, 100.0)}
