"""The streamed fact in batches of bounded size, whose files and shuffles do not pile up."""

import datetime as dt
import pathlib

from test_ordered import multiset

from tillmark.registered import queries
from tillmark.sources.feeds import IGA
from tillmark.streaming import facts, ingest
from tillmark.streaming.checked import expectation_log


def order_tables(spark, folder, lines=400):
    """Order lines and parts of the registered queries."""
    parts = [(n, f"large ring {n}", f"Brand#{n % 5}", ("SMALL", "LARGE", "PROMO", "ECONOMY")[n % 4], n % 50 + 1, 900.0) for n in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    day = dt.datetime(1996, 9, 13)
    rows = [
        (n // 4, n * 7 % 60, n % 9, n % 4 + 1, float(n % 50 + 1), 900.0 + n, n % 10 / 100, 0.02, "NRA"[n % 3], "OF"[n % 2], day + dt.timedelta(n % 40))
        for n in range(lines)
    ]
    spark.createDataFrame(
        rows,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
        " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_files_of_one_feed_lie_there_at_a_time(spark, tmp_path, monkeypatch):
    found, write = [], queries._write_csv

    def noted(rows, folder):
        write(rows, folder)
        found.append({path.relative_to(pathlib.Path(folder).parent).parts[0] for path in pathlib.Path(folder).parent.rglob("*.csv")})

    monkeypatch.setattr(queries, "_write_csv", noted)
    monkeypatch.setattr(queries, "work_folder", lambda spark, purpose: f"{tmp_path}/work")
    data = order_tables(spark, tmp_path / "data")
    got = queries.fact_price_streamed(spark, data)
    whole = queries.fact_price_from_text(spark, data).drop("_source_file")
    assert multiset(got.select(*whole.columns)) == multiset(whole) and got.count() > 100
    assert found == [{"aldi"}, {"coles"}, {"iga"}, {"woolworths"}] and not [*(tmp_path / "work" / "in").rglob("*.csv")]


def test_a_batch_takes_a_bounded_part_of_the_raw_tables(spark, tmp_path):
    head = "Date,Product Name,SKU,Price,Price per unit,Main Category,Sub Category,Product URL\n"
    for day in range(1, 5):
        folder = tmp_path / "in" / "iga" / f"date=2021-05-0{day}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(head + f"2021-05-0{day},Milk {day},7{day},$1.{day}0,,pantry,,u\n")
        raw = ingest.ingest_all(spark, f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/c")
    assert spark.read.parquet(raw[IGA.folder]).count() == 4
    for name, most, batches in (("few", 1, 4), ("all", facts.BYTES_PER_BATCH, 1)):
        facts.run_fact(spark, raw, f"{tmp_path}/{name}", f"{tmp_path}/c/{name}", bytes_per_batch=most)
        fact, log = facts.fact_table(spark, f"{tmp_path}/{name}"), expectation_log(spark, f"{tmp_path}/{name}_log")
        assert sorted(row.price_aud for row in fact.collect()) == [1.1, 1.2, 1.3, 1.4]
        kept = [row.passed for row in log.where("expectation = 'drop_rules'").collect() if row.passed]
        assert len(kept) == batches and sum(kept) == 4
