"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from tillmark.functions.unit_price import with_unit_price
from tillmark.operators.history import HistorySpec, versions
from tillmark.plans import dimensions, marts
from tillmark.plans.conform import conform, conform_all
from tillmark.plans.fact import FACT_SCHEMA, fact_price
from tillmark.sources.feeds import FEEDS


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Empty stored raw tables."""
    root = tmp_path_factory.mktemp("raw")
    tables = []
    for feed in FEEDS:
        spark.createDataFrame([], feed.stored_schema()).write.parquet(f"{root}/{feed.folder}")
        tables.append((feed, spark.read.parquet(f"{root}/{feed.folder}")))
    return tables


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    """An empty stored fact."""
    root = tmp_path_factory.mktemp("fact")
    schema = FACT_SCHEMA
    spark.createDataFrame([], schema).write.parquet(f"{root}/fact")
    return spark.read.schema(schema).parquet(f"{root}/fact")


def test_no_python_in_the_fact(raw):
    plan = plan_of(fact_price(conform_all(raw)))
    assert "Python" not in plan and "Exchange" not in plan


def test_conform_reads_only_what_it_needs(raw):
    feed, table = raw[0]
    plan = plan_of(conform(table, feed).select("price_aud", "product_name"))
    (columns,) = re.findall(r"ReadSchema: (.*)", plan)
    assert columns == "struct<Product:string,Price:string>"


def test_trusted_filter_reaches_the_scan(fact):
    plan = plan_of(marts.fact_price_daily(fact))
    assert "Not(EqualTo(is_quarantined,true))" in plan.replace(" ", "") or "EqualTo(is_quarantined,false)" in plan
    assert plan.count("Window [") + plan.count("(Window)") <= 2


def test_daily_fact_shuffles_by_range_and_joins_nothing(fact):
    """Copies are counted, rows dealt by range, then met inside and across ranges."""
    plan = plan_of(marts.fact_price_daily(fact))
    assert len(re.findall(r"\(\d+\) Exchange", plan)) == 4 and "rangepartitioning" in plan
    assert "Join" not in plan and len(re.findall(r"\(\d+\) Scan", plan)) == 1


def test_history_looks_share_their_ranges(fact):
    seen = fact.select("product_sk", "snapshot_date", "brand")
    plan = plan_of(versions(seen, HistorySpec(("product_sk",), "snapshot_date", ("brand",))))
    assert plan.count("Arguments: rangepartitioning") == 1 and "Join" not in plan
    assert len(re.findall(r"\(\d+\) Exchange", plan)) == 5


def test_categories_are_found_by_hash(fact):
    """Only different rows are sorted, after a hash aggregate over all rows."""
    plan = plan_of(dimensions.dim_category(fact))
    numbered = {int(number): name for number, name in re.findall(r"^\((\d+)\) (\w+)", plan, re.M)}
    nodes = [numbered[number] for number in sorted(numbered)]  # from the scan upwards
    assert nodes.index("HashAggregate") < nodes.index("Exchange") < nodes.index("Sort")


@pytest.mark.parametrize("mart", [marts.mart_availability, marts.mart_dq_scorecard])
def test_aggregates_combine_before_the_shuffle(fact, mart):
    plan = plan_of(mart(fact))
    assert "partial_" in plan or plan.count("HashAggregate") + plan.count("SortAggregate") >= 4
    assert len(re.findall(r"\(\d+\) Exchange", plan)) == 1


def test_availability_reads_three_columns(fact):
    (columns,) = set(re.findall(r"ReadSchema: (.*)", plan_of(marts.mart_availability(fact))))
    assert columns == "struct<retailer:string,availability:string,snapshot_date:date>"


def test_unit_price_stays_in_the_jvm(spark):
    plan = plan_of(with_unit_price(spark.range(5).select(F.col("id").cast("string").alias("raw")), "raw", "unit"))
    assert "Python" not in plan


def test_calendar_needs_no_driver_round_trip(fact):
    assert dimensions.dim_date(fact).count() == 0
    assert "Generate" in plan_of(dimensions.dim_date(fact))


def test_stored_schema_is_that_of_the_fact(raw):
    made = fact_price(conform_all(raw)).schema
    assert [(field.name, field.dataType) for field in made] == [(field.name, field.dataType) for field in FACT_SCHEMA]


def test_two_facts_in_one_query(raw):
    both = fact_price(conform_all(raw), "one").unionByName(fact_price(conform_all(raw), "two"))
    assert both.count() == 0
