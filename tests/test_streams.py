"""Files, streams and the daily run."""

import datetime as dt
import pathlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from test_ordered import DAY, HISTORY_SCHEMA, SPEC, brute_history, history_rows, multiset
from tillmark.operators.quality import FACT_EXPECTATIONS
from tillmark.plans.daily import DESCRIBED, daily_run
from tillmark.session import work_folder
from tillmark.sources import landing, parted, raw_files, tables
from tillmark.sources.feeds import ALDI, COLES, FEEDS, column_or_null, stored_name, with_stored_names
from tillmark.streaming import distinct, facts, history, ingest
from tillmark.streaming import landing as landed
from tillmark.streaming.checked import expectation_log, store_checked

COLES_HEADER = ",".join(COLES.headers)


def put(folder, name, text):
    path = pathlib.Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def coles_row(day, sku, price, suppliers="[]", category="bakery", name="bread", unit="$1.00 per 100g"):
    return f'{day},{name},{sku},Brand,1 each,{price},,{unit},,Available,{suppliers},{category},http://c/{sku}\n'


def test_stored_names(spark):
    assert [stored_name(n) for n in ("Unit Price", " a;b ", "_x y", "a=(b)")] == ["Unit_Price", "a_b", "_x_y", "a_b"]
    assert with_stored_names(spark.createDataFrame([(1,)], "`Unit Price` int")).columns == ["Unit_Price"]
    df = spark.createDataFrame([("x", "y")], "`Unit Price` string, Sub_Category string")
    got = df.select(*[column_or_null(df, n).alias(n) for n in ("Unit Price", "Sub Category", "Missing")]).first()
    assert tuple(got) == ("x", "y", None)


def test_ingest_takes_each_file_once(spark, tmp_path):
    put(tmp_path, "in/coles/date=2021-04-23/coles_2021-04-23.csv", COLES_HEADER + "\n" + coles_row("x", 1, 2.5))
    where = (COLES, f"{tmp_path}/in/coles", f"{tmp_path}/raw", f"{tmp_path}/check")
    ingest.ingest(spark, *where)
    ingest.ingest(spark, *where)
    assert ingest.raw_table(spark, COLES, f"{tmp_path}/raw").count() == 1
    put(tmp_path, "in/coles/date=2021-04-24/coles_2021-04-24.csv", COLES_HEADER + "\n" + coles_row("x", 2, 3.5) * 2)
    ingest.ingest(spark, *where)
    rows = ingest.raw_table(spark, COLES, f"{tmp_path}/raw").orderBy("_snapshot_date").collect()
    assert [(r.SKU, r.Date, r._snapshot_date) for r in rows] == [
        ("1", "x", dt.date(2021, 4, 23)), ("2", "x", dt.date(2021, 4, 24)), ("2", "x", dt.date(2021, 4, 24)),
    ]
    assert rows[0]._source_file.endswith("date=2021-04-23/coles_2021-04-23.csv") and rows[0]._rescued_data is None
    assert rows[0]._ingest_ts is not None


def test_quoted_list_cell_does_not_shift_columns(spark, tmp_path):
    cell = "\"[\"\"720488 L'OREAL\"\", 'x, y']\""
    put(tmp_path, "in/a.csv", COLES_HEADER + "\n" + coles_row("d", 7, 2.5, suppliers=cell))
    row = raw_files.read_feed(spark, COLES, raw_files.list_files(spark, f"{tmp_path}/in")).first()
    assert row.Suppliers == "[\"720488 L'OREAL\", 'x, y']" and row.Category == "bakery" and row.URL == "http://c/7"
    assert row._snapshot_date is None


def test_layouts_are_read_by_name_and_extras_rescued(spark, tmp_path):
    put(tmp_path, "in/a b+é.csv", "﻿Product,Price,Colour,Date\r\nTea,$2.00,red,d\r\nJam,$3.00,,d\r\n")
    put(tmp_path, "in/[2] {x}.csv", "Date,Product,Price\nd,Milk,1.00\n")
    put(tmp_path, "in/empty.csv", "")
    put(tmp_path, "in/notes.txt", "Date,Product\nd,No\n")
    rows = raw_files.read_feed(spark, ALDI, raw_files.list_files(spark, f"{tmp_path}/in")).orderBy("Price").collect()
    assert [(r.Product, r.Price, r.Unit_Price, r._rescued_data) for r in rows] == [
        ("Tea", "$2.00", None, '{"Colour":"red"}'), ("Jam", "$3.00", None, None), ("Milk", "1.00", None, None),
    ]


def test_missing_feeds_and_expectation_counts(spark, tmp_path):
    """One feed only; the counts of dropped rows and missed expectations are in the progress."""
    body = coles_row("d", 1, 2.5) + coles_row("d", 2, "") + coles_row("d", 3, 4, name=" ") + coles_row("d", 4, 4, category="liquor")
    put(tmp_path, "in/coles/date=2021-04-23/c.csv", COLES_HEADER + "\n" + body)
    raw = ingest.ingest_all(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c")
    for _ in range(2):  # nothing new the second time
        facts.run_fact(spark, raw, f"{tmp_path}/t/fact", f"{tmp_path}/c/fact")
    counts = {(row.batch, row.expectation): (row.on_fail, row.passed, row.failed) for row in expectation_log(spark, f"{tmp_path}/t/fact_log").collect()}
    assert counts == {
        (0, "drop_rules"): ("drop", 1, 2), (0, "valid_retailer"): ("drop", 1, 0), (0, "has_product_name"): ("drop", 1, 0),
        (0, "price_present_or_unavailable"): ("warn", 1, 0),
    }
    assert [r.source_sku for r in facts.fact_table(spark, f"{tmp_path}/t/fact").collect()] == ["1"]
    assert facts.fact_table(spark, f"{tmp_path}/t/fact", ["2021-04-24"]).count() == 0


def test_a_batch_adds_one_file_per_date(spark, tmp_path):
    rows = spark.range(3_000).selectExpr("date_add(date'2021-04-23', cast(id % 5 as int)) as day", "id").repartition(7)

    def judged(batch, seen, dropped):
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.lit(0).alias(f"{e.name}_failed") for e in FACT_EXPECTATIONS])
        return counted.observe(dropped, F.count(F.lit(1)).alias("rows"), F.lit(0).alias("rows_dropped"))

    for number in (0, 1, 1):
        store_checked(rows, judged, "day", f"{tmp_path}/t", f"{tmp_path}/log", number)
    for number in (0, 1):
        written = [p.parent.name for p in (tmp_path / "t" / f"v={number}").rglob("*.parquet")]
        assert sorted(written) == [f"_part=2021-04-{day}+" for day in range(23, 28)]
    assert expectation_log(spark, f"{tmp_path}/log").groupBy("batch").count().count() == 2


def test_reset_starts_a_stream_over(spark, tmp_path):
    put(tmp_path, "in/a.csv", COLES_HEADER + "\n" + coles_row("d", 1, 2.5))
    where = (COLES, f"{tmp_path}/in", f"{tmp_path}/raw", f"{tmp_path}/check")
    ingest.ingest(spark, *where)
    tables.reset(spark, *where[2:])
    ingest.ingest(spark, *where)
    assert ingest.raw_table(spark, COLES, where[2]).count() == 1


def test_landing(spark, tmp_path):
    names = {
        "a/2021-04-23 WOW Data.csv": "1", "a/2021-04-23 Coles Data.csv": "22", "b/2021-04-23 COLES Data.csv": "333",
        "notes.csv": "x", "2021-04-23 shop.csv": "x", "iga.csv": "x", "2021-04-23 Aldi.txt": "x",
        "Big+ é 2021-05-01 2022-01-01 iga.csv": "é",
    }
    for name, content in names.items():
        put(tmp_path, f"in/{name}", content)
    plan = landing.landing_plan(raw_files.list_files(spark, f"{tmp_path}/in"), "raw/")
    planned = {r.source.split("/in/")[1]: (r.target, r.reason) for r in plan.collect()}
    coles = "raw/coles/date=2021-04-23/coles_2021-04-23.csv"
    assert planned == {
        "a/2021-04-23 WOW Data.csv": ("raw/woolworths/date=2021-04-23/woolworths_2021-04-23.csv", None),
        "a/2021-04-23 Coles Data.csv": (coles, "superseded"),
        "b/2021-04-23 COLES Data.csv": (coles, None),
        "notes.csv": (None, "cannot classify"),
        "2021-04-23 shop.csv": (None, "cannot classify"),
        "iga.csv": (None, "cannot classify"),
        "Big+ é 2021-05-01 2022-01-01 iga.csv": ("raw/iga/date=2021-05-01/iga_2021-05-01.csv", None),
    }
    report = landing.land(spark, f"{tmp_path}/in", f"file:{tmp_path}/out/raw", f"{tmp_path}/report")
    assert {r.bytes for r in report.collect()} == {1, 3, 2, None}
    landed = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert landed == {
        coles: "333",
        "raw/woolworths/date=2021-04-23/woolworths_2021-04-23.csv": "1",
        "raw/iga/date=2021-05-01/iga_2021-05-01.csv": "é",
    }


def test_landing_in_runs(spark, tmp_path):
    where = ("raw", f"{tmp_path}/landed", f"{tmp_path}/log")

    def land(number, *paths):
        files = spark.createDataFrame([(path,) for path in paths], "path string")
        landed.land_batch(files, *where, number)
        rows = landed.landing_log(spark, where[2]).where(F.col("batch") == number).collect()
        return Counter((r.source, r.reason, r.replaces) for r in rows)

    def now():
        return {r.target.split("/")[-1]: (r.source, r.batch) for r in landed.landed_files(spark, where[1]).collect()}

    aldi, coles = "aldi_2021-04-23.csv", "coles_2021-04-23.csv"
    assert land(0) == {} and now() == {}
    first = ("b/2021-04-23 aldi.csv", "a/2021-04-23 aldi.csv", "a/2021-04-23 coles.csv", "notes.csv", None)
    told = {
        (first[0], None, None): 1, (first[1], "superseded", None): 1, (first[2], None, None): 1,
        (first[3], "cannot classify", None): 1, (None, "cannot classify", None): 1,
    }
    assert land(1, *first) == told and now() == {aldi: (first[0], 1), coles: (first[2], 1)}
    # a later file wins although its path sorts first; a file that lands again replaces no other
    again = ("a/2021-04-23 ALDI new.csv", first[2])
    for _ in range(2):  # a repeated run starts from the runs before its own
        assert land(2, *again) == {(again[0], None, first[0]): 1, (again[1], None, None): 1}
        assert now() == {aldi: (again[0], 2), coles: (first[2], 2)}
    assert landed.landing_log(spark, where[2]).count() == 7
    # only the buckets of a run's targets are written
    written = set(parted.folders(spark, where[1]))
    land(3, "2021-04-23 coles.csv")
    assert len([f for part in parted.folders(spark, where[1]).values() for f in part if "/v=3/" in f]) == 1
    assert set(parted.folders(spark, where[1])) == written


@pytest.mark.parametrize("shuffled", [True, False])
def test_history_stream_equals_batch(spark, tmp_path, shuffled):
    rows = history_rows(seed=5)
    if not shuffled:
        rows.sort(key=lambda row: row[1])
    table = f"{tmp_path}/table"
    for part in range(4):
        cut = rows[part * 125 : (part + 1) * 125]
        spark.createDataFrame(cut, HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(table)
        schema = spark.read.parquet(table).schema
        history.run_history(spark, table, schema, f"{tmp_path}/dim", f"{tmp_path}/check", SPEC, 1, buckets=3)
        got = history.current(spark, f"{tmp_path}/dim", schema, SPEC)
        assert multiset(got) == brute_history(rows[: (part + 1) * 125])
    history.run_history(spark, table, schema, f"{tmp_path}/dim", f"{tmp_path}/check", SPEC, buckets=3)
    assert multiset(history.current(spark, f"{tmp_path}/dim", schema, SPEC)) == brute_history(rows)


def test_repeated_batch_gives_the_same_version(spark, tmp_path):
    rows = history_rows(seed=6)
    first, second = (spark.createDataFrame(part, HISTORY_SCHEMA) for part in (rows[:250], rows[250:]))
    where = f"{tmp_path}/dim"
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        history.bring_up_to_date(batch, where, number, SPEC, buckets=3)
    assert multiset(history.current(spark, where, first.schema, SPEC)) == brute_history(rows)


def test_old_versions_go(spark, tmp_path):
    for version in range(4):
        tables.publish(spark.range(version), f"{tmp_path}/t", version)
    assert tables.latest(spark, f"{tmp_path}/t").count() == 3
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v=2", "v=3"]
    assert tables.latest(spark, f"{tmp_path}/none") is None


def test_distinct_stream(spark, tmp_path):
    table = f"{tmp_path}/in"
    for part in (["a", "b", "a"], ["b", "c"], ["a"]):
        rows = [(v, v.upper(), i) for i, v in enumerate(part)]
        spark.createDataFrame(rows, "k string, up string, n int").write.mode("append").parquet(table)
        stream = spark.readStream.schema("k string, up string, n int").parquet(table).select("k", "up")
        distinct.run_distinct(stream, ["k"], f"{tmp_path}/out", f"{tmp_path}/check")
    got = distinct.current(spark, f"{tmp_path}/out", spark.createDataFrame([], "k string, up string").schema)
    assert multiset(got) == Counter([("a", "A"), ("b", "B"), ("c", "C")])
    # every batch writes the keys that are new: two, one, none
    sizes = [spark.read.parquet(*found).count() if (found := [str(p) for p in (tmp_path / "out" / f"v={n}").rglob("*.parquet")]) else 0 for n in range(3)]
    assert sizes == [2, 1, 0]


def test_new_keys_when_one_is_null_or_has_several_rows(spark, tmp_path):
    schema = "k string, v string"
    for number, rows in enumerate([[(None, "b"), (None, "a"), ("x", None)], [(None, "a"), ("x", "y"), ("z", "z")]]):
        for _ in range(2):
            distinct.add_new_keys(spark.createDataFrame(rows, schema), ["k"], f"{tmp_path}/t", number)
    got = distinct.current(spark, f"{tmp_path}/t", spark.createDataFrame([], schema).schema)
    assert multiset(got) == Counter([(None, "a"), ("x", None), ("z", "z")])


def test_catalogue_table(spark):
    df = spark.range(3).withColumn("d", F.lit("x"))
    spark.sql("create database if not exists shop")
    table = tables.catalogue_table(df, "shop.prices", "Daily 'price' fact", {"quality": "gold"}, partition_by="d")
    assert table.count() == 3
    described = {r.col_name: r.data_type for r in spark.sql("describe table extended shop.prices").collect()}
    assert described["Comment"] == "Daily 'price' fact" and "quality=gold" in described["Table Properties"]


def test_source_root(spark):
    assert raw_files.source_root(spark, "/data/raw") == "/data/raw"
    spark.conf.set("source.root", "/other")
    assert raw_files.source_root(spark, "/data/raw") == "/other"
    spark.conf.unset("source.root")


def test_work_folders_lie_in_the_shared_folder(spark):
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def write_day(root, day, prices):
    rows = "".join(coles_row(day, sku, price) for sku, price in prices.items())
    put(root, f"coles/date={day}/coles_{day}.csv", COLES_HEADER + "\n" + rows)
    put(root, f"aldi/date={day}/aldi_{day}.csv", ",".join(ALDI.headers) + f"\n{day},Tea Bags,$4.00,$1.00 per 100g,groceries,pantry,u\n")
    iga = "Date,Product Name,SKU,Price,Price per unit,Main Category,Sub Category,Product URL\n"
    put(root, f"iga/date={day}/iga_{day}.csv", iga + f"{day},jam 500gm,5.0,$2000,$5 per kg,pantry,,u\n{day},x,6.0,,,pantry,,u\n")
    wow = "Date,Product Name,SKU,Brand,Price,Price per unit,Package Size,Specials,Availability,Ratings,Department,Product URL\n"
    put(root, f"woolworths/date={day}/woolworths_{day}.csv", wow + f"{day},Milk,9,B,,,2l,Save $1,Unavailable,4.5,['Bakery'],u\n{day},Gin,8,B,9,,1l,,Available,,['Liquor'],u\n")


def test_daily_run(spark, tmp_path):
    root, where = tmp_path / "in", (f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checks")
    write_day(root, "2021-04-23", {1: 10, 2: 5})
    daily_run(spark, *where)
    write_day(root, "2021-04-24", {1: 12, 2: 5000})
    write_day(root, "2021-04-25", {1: 9, 2: 6})
    done = daily_run(spark, *where, catalogue="shop_daily")

    described = {name: tables.described(spark, f"shop_daily.{name}") for name in DESCRIBED}
    assert {name: (told[1]["quality"], told[0]) for name, told in described.items()} == DESCRIBED
    for name in DESCRIBED:
        entry = spark.table(f"shop_daily.{name}").drop("_version", "_part")
        assert entry.exceptAll(done[name]).count() == 0 == done[name].exceptAll(entry).count()
    one_day = spark.sql("select * from shop_daily.fact_price where _part = '2021-04-24'")
    assert "04-25" not in str(one_day.inputFiles()) and one_day.count() == 5
    fact = done["fact_price"]
    assert fact.columns[:24][-1] == "_ingest_ts" and len(fact.columns) == 29
    assert Counter(r.retailer for r in fact.collect()) == {"Aldi": 3, "Coles": 6, "IGA": 3, "Woolworths": 3}
    reasons = Counter(r.dq_reason for r in done["fact_price_quarantine"].collect())
    assert reasons == {"price_out_of_range:2000.0": 3, "unavailable_no_price": 3, "price_out_of_range:5000.0": 1}
    daily = done["fact_price_daily"].filter("retailer = 'Coles'").orderBy("source_sku", "snapshot_date").collect()
    assert [(r.price_aud, r.prev_day_price, r.price_change_pct) for r in daily] == [
        (10.0, None, None), (12.0, 10.0, 20.0), (9.0, 12.0, -25.0), (5.0, None, None), (6.0, 5.0, 20.0),
    ]
    assert done["dim_product"].count() == 5 and done["dim_product"].filter("__END_AT is not null").count() == 0
    assert {r.canonical_l2 for r in done["dim_category"].collect()} == {"Pantry", "Bakery"}
    assert done["dim_date"].count() == 3 and done["dim_retailer"].count() == len(FEEDS)
    rates = {(r.retailer, r.availability_rate) for r in done["mart_availability"].collect()}
    assert rates == {("Aldi", 0.0), ("Coles", 100.0), ("IGA", 0.0), ("Woolworths", 0.0)}
    scores = {(str(r.snapshot_date), r.retailer): r.quarantine_pct for r in done["mart_dq_scorecard"].collect()}
    assert scores["2021-04-24", "Coles"] == 50.0
