"""What travels: whole rows once for a history, rows of a key together for look-backs."""

import datetime as dt
import re

from pyspark.sql import functions as F
from test_plans import plan_of

from tillmark.operators.history import END, START, HistorySpec, scd2
from tillmark.operators.ordered import digests, with_previous_value

DAY = dt.date(2021, 4, 23)
SPEC = HistorySpec(keys=("k",), sequence="day", tracked=("a", "x"), leave_out=("file",), prefer=("file",))
SCHEMA = "k string, day date, a string, x double, wide string, file string"


def exchanges(plan):
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (.*)", plan)


def test_whole_rows_of_a_history_are_dealt_one_way(spark):
    """Both branches name one shuffle, which adaptive execution makes once."""
    found = exchanges(plan_of(scd2(spark.createDataFrame([], SCHEMA), SPEC)))
    wide = [re.sub(r"#\d+L?|, \d+\), .*", "", how) for columns, how in found if "wide#" in columns]
    assert len(found) == 8 and len(wide) == 2 and len(set(wide)) == 1


def test_rows_are_sorted_before_they_are_dealt_again(spark):
    df = spark.createDataFrame([], "k string, day date, price double")
    plan = plan_of(with_previous_value(df, "k", "day", "price", "was"))
    nodes = re.findall(r"^\(\d+\) (Exchange|Sort|Window)\b", plan, re.M)  # from the scan upwards
    assert nodes == ["Exchange", "Exchange", "Sort", "Exchange", "Sort", "Window", "Exchange", "Sort", "Window"]


def test_history_with_nulls_zeros_and_no_numbers(spark):
    """Digests tell null from empty and zero from nothing, and take -0.0 for 0.0."""
    nan, days = float("nan"), [DAY + dt.timedelta(n) for n in range(9)]
    values = [(None, 0.0), (None, -0.0), ("", 0.0), ("", None), (None, None), ("", nan), ("", nan), ("x", nan), ("x", None)]
    for key in ("p", None):
        rows = [(key, day, *value, f"w{n}", "f") for n, (day, value) in enumerate(zip(days, values, strict=True))]
        got = scd2(spark.createDataFrame(rows, SCHEMA), SPEC).orderBy(START).collect()
        assert [(row[START], row[END], row.wide) for row in got] == [
            (days[0], days[2], "w1"), (days[2], days[3], "w2"), (days[3], days[4], "w3"), (days[4], days[5], "w4"),
            (days[5], days[7], "w6"), (days[7], days[8], "w7"), (days[8], None, "w8"),
        ]


def test_history_of_nested_values(spark):
    spec = HistorySpec(keys=("k",), sequence="n", tracked=("v",))
    rows = [({"a": 1}, 1, [[1], [2]]), ({"a": 1}, 2, [[1, 2]]), ({"a": 1}, 3, [[1, 2]]), ({"a": None}, 1, None), (None, 1, [])]
    df = spark.createDataFrame([((key or {}).get("a") if key else None, n, v) for key, n, v in rows], "a int, n int, v array<array<int>>")
    df = df.select(F.struct("a").alias("k"), "n", "v")
    assert "__K0" in digests(df, ["k"], "__K") and len(digests(df, ["n"], "__K")) == 2
    got = scd2(df.where("v is not null and size(v) > 0"), spec)
    assert {(row.k.a, row.n, row[START], row[END]) for row in got.collect()} == {(1, 1, 1, 2), (1, 3, 2, None)}
