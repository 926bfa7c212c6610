"""Histories whose whole rows are dealt once, by key, but for those of busy keys."""

import datetime as dt
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F
from test_narrow_rows import exchanges
from test_ordered import DAY, HISTORY_SCHEMA, SPEC, brute_history, history_rows, multiset
from test_plans import plan_of

from tillmark.operators import history, ordered
from tillmark.operators.history import END, START, HistorySpec, scd2
from tillmark.session import RELEASE_SETTING
from tillmark.streaming import history as streamed
from tillmark.streaming.late import maybe_of_keys, of_keys
from tillmark.streaming.runs import run_batches


def looking(monkeypatch, module, busy_seen):
    """Every row is looked at, and so many make a key busy."""
    monkeypatch.setattr(module, "busy_keys", partial(ordered.busy_keys, share=1.0, busy_seen=busy_seen))


def test_busy_keys_are_found(spark):
    df = spark.range(400).selectExpr("case when id % 4 > 0 then null else id end as k", "id as n")
    busy = ordered.busy_keys(df, ["k"], 1.0, 100)
    assert busy.found.count() == 1 and busy.among(df).columns == ["k", "n"]
    assert busy.among(df).select("k").distinct().collect() == [(None,)] and busy.without(df).count() == 100
    assert ordered.busy_keys(df, ["k"], 1.0, 301).among(df) is None
    assert ordered.busy_keys(df.where("n < 0"), ["k"], 1.0) is None


def test_whole_rows_of_a_history_travel_once_and_nothing_else_does(spark, monkeypatch):
    looking(monkeypatch, history, 1_000)
    rows = spark.createDataFrame(history_rows(), HISTORY_SCHEMA).repartition(3)
    found = exchanges(plan_of(scd2(rows, SPEC).where("k is not null")))
    assert [re_dealt for _, re_dealt in found if "hashpartitioning" in re_dealt and "k#" in re_dealt] and len(found) == 2


@pytest.mark.parametrize("busy_seen", [1, 20, 100, 1_000])
def test_history_with_and_without_busy_keys(spark, monkeypatch, busy_seen):
    looking(monkeypatch, history, busy_seen)
    rows = [(None if key == "hot" else key, *rest) for key, *rest in history_rows()]
    got = scd2(spark.createDataFrame(rows, HISTORY_SCHEMA).repartition(5), SPEC)
    assert got.columns == ["k", "day", "a", "b", "other", "file", START, END]
    assert multiset(got) == brute_history(rows)


def test_columns_named_like_those_of_a_look(spark, monkeypatch):
    looking(monkeypatch, history, 1_000)
    spec = HistorySpec(keys=("k",), sequence="day", tracked=("_now",))
    rows = [("k", DAY + dt.timedelta(n), n // 2, f"w{n}", f"b{n}") for n in range(4)]
    df = spark.createDataFrame(rows, "k string, day date, _now int, _was string, _Begin string")
    want = Counter({(*rows[1], rows[0][1], rows[2][1]): 1, (*rows[3], rows[2][1], None): 1})
    assert multiset(scd2(df.unionByName(df.where(F.col("day") > DAY)), spec)) == want


@pytest.mark.parametrize("busy_seen", [1, 20, 60, 1_000])
def test_streamed_history_with_and_without_busy_keys(spark, tmp_path, monkeypatch, busy_seen):
    """Most keys come late in some batch, some keep to their order, and null keys and days are there."""
    looking(monkeypatch, streamed, busy_seen)
    rows = [(None if key == "hot" else key, *rest) for key, *rest in history_rows(seed=8)]
    rows = sorted(rows[:350], key=lambda row: row[1]) + rows[350:]
    for number, some in enumerate((rows[:200], rows[200:350], rows[350:380], rows[380:])):
        batch = spark.createDataFrame(some, HISTORY_SCHEMA)
        streamed.bring_up_to_date(batch, f"{tmp_path}/h", number, SPEC, buckets=3, piece_rows=40)
        got = streamed.current(spark, f"{tmp_path}/h", batch.schema, SPEC)
        assert multiset(got) == brute_history(rows[: (200, 350, 380, 500)[number]])


def test_closed_versions_stay_beside_late_keys(spark, tmp_path, monkeypatch):
    """Also one that began with a row without a day."""
    looking(monkeypatch, streamed, 1_000)
    schema, spec = "k string, day date, a string", HistorySpec(keys=("k",), sequence="day", tracked=("a",))
    day = [DAY + dt.timedelta(n) for n in range(5)]
    first = [("a", None, "x"), ("a", day[1], "x"), ("a", day[2], "y"), ("b", day[0], "x"), ("b", day[2], "y"), ("b", day[3], "x")]
    for number, rows in enumerate((first, [("b", day[1], "z")])):
        streamed.bring_up_to_date(spark.createDataFrame(rows, schema), f"{tmp_path}/h", number, spec, buckets=1)
    got = streamed.current(spark, f"{tmp_path}/h", spark.createDataFrame(first, schema).schema, spec)
    assert multiset(got) == Counter([
        ("a", day[1], "x", None, day[2]), ("a", day[2], "y", day[2], None), ("b", day[0], "x", day[0], day[1]),
        ("b", day[1], "z", day[1], day[2]), ("b", day[2], "y", day[2], day[3]), ("b", day[3], "x", day[3], None),
    ])


def test_a_streamed_history_deals_whole_rows_once_per_table(spark, tmp_path, monkeypatch):
    looking(monkeypatch, streamed, 1_000)
    plans, store = [], streamed.parted.store
    monkeypatch.setattr(streamed.parted, "store", lambda df, *rest, **more: plans.append(plan_of(df)) or store(df, *rest, **more))
    rows = history_rows()
    for number, some in enumerate((rows[:300], rows[300:])):
        streamed.bring_up_to_date(spark.createDataFrame(some, HISTORY_SCHEMA), f"{tmp_path}/h", number, SPEC, buckets=3)
    for seen, _, versions in (plans[:3], plans[3:]):
        wide = [[columns for columns, _ in exchanges(plan) if "other#" in columns] for plan in (seen, versions)]
        assert [len(found) for found in wide] == [1, 1]
        assert versions.count(") Sort\n") == 1 and "SortMergeJoin" not in versions


def test_shuffles_of_a_batch_are_released(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    found = []

    def note(batch, number):
        found.append(batch.sparkSession.conf.get(RELEASE_SETTING))

    run_batches(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), note, f"{tmp_path}/c")
    assert found == ["true"] and spark.conf.get(RELEASE_SETTING) == "false"


@pytest.mark.parametrize("bits", [1 << 6, 1 << 9, 1 << 24])
def test_rows_that_may_be_of_some_keys(spark, bits):
    rows = spark.range(3_000).selectExpr("case when id % 500 > 0 then id % 1000 end as k", "cast(id % 7 as string) as m")
    some = rows.where("k % 50 = 3 or k is null and m = '2'").distinct()
    got, exact = maybe_of_keys(rows, some, ["k", "m"], bits), of_keys(rows, some, ["k", "m"])
    assert got.columns == ["k", "m"] and exact.exceptAll(got).count() == 0 and got.exceptAll(rows).count() == 0
    assert got.count() == exact.count() if bits > 1 << 9 else got.count() <= 3_000
