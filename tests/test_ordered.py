"""Neighbour look-ups and histories, for ordinary and for hot keys."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillmark.operators.history import END, START, HistorySpec, scd2
from tillmark.operators.ordered import ranged, with_neighbours, with_previous_value

DAY = dt.date(2021, 4, 23)


@pytest.fixture
def settings(spark):
    """Sets the number of ranges, whatever the size of the data."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}

    def choose(ranges):
        for name, value in zip(names, (str(ranges), "false"), strict=True):
            spark.conf.set(name, value)

    yield choose
    for name, value in before.items():
        spark.conf.set(name, value)


def multiset(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_neighbours(spark, settings, ranges):
    settings(ranges)
    rng = random.Random(1)
    rows = [("hot", n, rng.choice([None, 1, 2, 3])) for n in rng.sample(range(5000), 300)]
    rows += [(f"k{i % 20}", n, n % 3) for i, n in enumerate(rng.sample(range(5000), 100))]
    rows += [(None, n, n) for n in range(9)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq long, v long").repartition(4)
    got = with_neighbours(df, ["k"], ["seq"], {"was": "v"}, {"next": "seq"})
    wanted = Counter()
    for key in {k for k, *_ in rows}:
        ordered = sorted((n, v) for k, n, v in rows if k == key)
        for i, (n, v) in enumerate(ordered):
            was = ordered[i - 1][1] if i else None
            after = ordered[i + 1][0] if i + 1 < len(ordered) else None
            wanted[key, n, v, was, after] += 1
    assert multiset(got.select("k", "seq", "v", "was", "next")) == wanted


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_previous_value(spark, settings, ranges):
    settings(ranges)
    rng = random.Random(2)
    rows = [("hot", DAY + dt.timedelta(rng.randrange(12)), rng.randrange(4) / 2 + 0.5, rng.choice("ab"), i % 2) for i in range(200)]
    rows += [("hot", DAY, 1.5, "a", 0)] * 50  # copies
    rows += [(f"k{i % 9}", DAY + dt.timedelta(i % 5), float(rng.randrange(3)), "c", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, day date, price double, tag string, n int").repartition(3)
    got = with_previous_value(df, "k", "day", "price", "before")
    wanted = Counter()
    for key in {k for k, *_ in rows}:
        ordered = sorted((day, price, n, tag) for k, day, price, tag, n in rows if k == key)
        for i, (day, price, n, tag) in enumerate(ordered):
            wanted[key, day, price, tag, n, ordered[i - 1][1] if i else None] += 1
    assert multiset(got.select("k", "day", "price", "tag", "n", "before")) == wanted


def test_copies_return_in_blocks(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.lit(DAY).alias("day"), F.lit(2.0).alias("price"))
    got = with_previous_value(df, "k", "day", "price", "before", copies_per_block=7)
    assert Counter(row.before for row in got.collect()) == {None: 1, 2.0: 99}


SPEC = HistorySpec(keys=("k",), sequence="day", tracked=("a", "b"), leave_out=("secret",), prefer=("file",))


def brute_history(rows):
    """rows: (k, day, a, b, other, file, secret)"""
    best = {}
    for k, day, a, b, other, file, _ in rows:
        candidate = (file, a or "", b or "", other)
        if (k, day) not in best or candidate > best[k, day][0]:
            best[k, day] = (candidate, (a, b, other, file))
    result = Counter()
    for key in {k for k, _ in best}:
        days = sorted(day for k, day in best if k == key)
        runs = []
        for day in days:
            a, b, other, file = best[key, day][1]
            if runs and runs[-1]["ab"] == (a, b):
                runs[-1].update(day=day, other=other, file=file)
            else:
                runs.append({"ab": (a, b), "start": day, "day": day, "other": other, "file": file})
        for i, run in enumerate(runs):
            end = runs[i + 1]["start"] if i + 1 < len(runs) else None
            result[(key, run["day"], *run["ab"], run["other"], run["file"], run["start"], end)] += 1
    return result


def history_rows(seed=3):
    rng = random.Random(seed)
    rows = []
    for n in range(500):
        key = "hot" if n % 2 else f"k{rng.randrange(15)}"
        day = DAY + dt.timedelta(rng.randrange(150 if key == "hot" else 30))
        rows.append((key, day, rng.choice(["x", "y"]), rng.choice([None, "z"]), n, f"f{n:04}", "s"))
    rng.shuffle(rows)
    return rows


HISTORY_SCHEMA = "k string, day date, a string, b string, other long, file string, secret string"


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_history(spark, settings, ranges):
    settings(ranges)
    rows = history_rows()
    got = scd2(spark.createDataFrame(rows, HISTORY_SCHEMA).repartition(5), SPEC)
    assert got.columns == ["k", "day", "a", "b", "other", "file", START, END]
    assert multiset(got) == brute_history(rows)


def test_history_of_a_a_b_a(spark):
    rows = [("p", DAY + dt.timedelta(i), v, None, i, "f", "s") for i, v in enumerate("AABA")]
    got = scd2(spark.createDataFrame(rows, HISTORY_SCHEMA), SPEC).orderBy(START).collect()
    assert [(row.a, (row[START] - DAY).days, row[END] and (row[END] - DAY).days) for row in got] == [
        ("A", 0, 2),
        ("B", 2, 3),
        ("A", 3, None),
    ]


def test_history_of_timestamps(spark):
    spec = HistorySpec(keys=("k",), sequence="ts", tracked=("a",))
    rows = [("k", dt.datetime(2024, 1, 1, 0, 0, i, 5), "ab"[i // 7 % 2]) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, a string")
    assert scd2(df, spec).count() == 8


@pytest.mark.parametrize("ranges", [1, 4, 30])
def test_null_keys_and_null_sequences(spark, settings, ranges):
    settings(ranges)
    day, far = DAY + dt.timedelta(1), DAY + dt.timedelta(9_000)
    rows = [("a", None, 5.0), ("a", None, 6.0), ("a", None, 5.0), ("a", DAY, 7.0), ("a", day, 8.0), ("a", far, 9.0)]
    rows += [(None, None, 1.0), (None, DAY, 2.0), (None, DAY, 2.0)]
    df = spark.createDataFrame(rows, "k string, day date, price double").repartition(3)
    was = [None, 5.0, 5.0, 6.0, 7.0, 8.0, None, 1.0, 2.0]
    in_order = [("a", None, 5.0), ("a", None, 5.0), ("a", None, 6.0), *rows[3:]]
    wanted = Counter((*row, before) for row, before in zip(in_order, was, strict=True))
    assert multiset(with_previous_value(df, "k", "day", "price", "was")) == wanted
    spec = HistorySpec(keys=("k",), sequence="day", tracked=("price",))
    spans = [("a", None, 6.0, None, DAY), ("a", DAY, 7.0, DAY, day), ("a", day, 8.0, day, far), ("a", far, 9.0, far, None)]
    spans += [(None, None, 1.0, None, DAY), (None, DAY, 2.0, DAY, None)]
    assert multiset(scd2(df, spec)) == Counter(spans)


def test_one_key_spreads_over_ranges(spark, settings):
    """One key, one far outlier, many rows alike in key, day and price: no range holds them all."""
    settings(16)
    rows = spark.range(20_000).selectExpr(
        "'k' as k", "case when id = 7 then date'2600-01-01' else date'2021-04-23' end as day", "2D as price", "id as n"
    )
    sizes = [row["count"] for row in ranged(rows, ["k"], ["day", "price", "n"]).groupBy("_range").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 4_000
    got = with_previous_value(rows, "k", "day", "price", "before")
    assert Counter(row.before for row in got.collect()) == {None: 1, 2.0: 19_999}


def test_text_sequences(spark):
    spec = HistorySpec(keys=("k",), sequence="s", tracked=("a",))
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "c", 1)], "k string, s string, a int")
    assert multiset(scd2(df, spec)) == Counter([("k", "a", 2, "a", "b"), ("k", "c", 1, "b", None)])


def test_streamed_history_keeps_null_keys_and_late_null_sequences(spark, tmp_path):
    from tillmark.streaming import history

    schema = "k string, day date, price double"
    spec = HistorySpec(keys=("k",), sequence="day", tracked=("price",))
    first = spark.createDataFrame([(None, DAY, 1.0), ("a", DAY, 1.0)], schema)
    fresh = spark.createDataFrame([(None, DAY + dt.timedelta(1), 2.0), ("a", None, 3.0)], schema)
    for number, batch in enumerate((first, fresh)):
        history.bring_up_to_date(batch, f"{tmp_path}/h", number, spec, buckets=2)
    whole = scd2(first.unionByName(fresh), spec)
    assert multiset(history.current(spark, f"{tmp_path}/h", first.schema, spec)) == multiset(whole)


def test_columns_named_like_helpers(spark):
    names = ("_before", "_After", "_slot", "_range_before", "_copies", "_block", "_found", "_copy")
    rows = [("k", DAY + dt.timedelta(n), float(n), *"abcdefgh") for n in range(3)]
    df = spark.createDataFrame(rows, "k string, day date, price double, " + ", ".join(f"{name} string" for name in names))
    got = with_previous_value(df, "k", "day", "price", "was")
    assert multiset(got) == Counter((*row, row[2] - 1 if row[2] else None) for row in rows)
