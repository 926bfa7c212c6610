"""The daily run, from landed files to marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.plans import dimensions
from tillmark.plans.fact import FACT_SCHEMA
from tillmark.sources.raw_files import source_root
from tillmark.sources.tables import catalogue_parts, catalogue_table, read_table, read_table_stream, write_table
from tillmark.streaming import daily, distinct, facts, history, ingest
from tillmark.streaming import marts as kept
from tillmark.streaming.checked import expectation_log

TIER = "quality"
# What the catalogue says of the tables: tier and comment.
DESCRIBED = {
    "fact_price": ("silver", "Price observations of all retailers in one shape, rows in doubt marked"),
    "dim_retailer": ("gold", "Retailers with parent company and type"),
    "dim_date": ("gold", "Calendar over the days of the price fact"),
    "dim_category": ("gold", "Shared two-level categories"),
    "mart_price_comparison": ("gold", "Mean unit prices by day, category and retailer, ranked"),
    "mart_specials_penetration": ("gold", "Share of products on special by day, retailer and category"),
    "mart_category_price_index": ("gold", "Unit prices by category and day against the first day"),
    "mart_availability": ("gold", "Products in and out of stock by day and retailer"),
    "mart_dq_scorecard": ("gold", "Rows, rows in doubt and rows without a price by day and retailer"),
}


def daily_run(
    spark: SparkSession, root: str | None, tables: str, checkpoints: str, catalogue: str | None = None
) -> dict[str, DataFrame]:
    """Process what is new below ``root`` (None: the session's ``source.root``); returns every
    table by name.

    Run it again after new files have landed: every table goes on where it stopped. The fact
    grows, the history, the daily fact and the marts rewrite the parts that new rows touch.
    Only the calendar and the retailers, a few rows, are written whole. With ``catalogue``, the
    name of a database, the tables of ``DESCRIBED`` are entered there with tier and comment.
    """
    raw = ingest.ingest_all(spark, root or source_root(spark), tables, checkpoints)
    fact_path, schema = f"{tables}/fact_price", FACT_SCHEMA
    facts.run_fact(spark, raw, fact_path, f"{checkpoints}/fact_price")
    facts.run_quarantine(spark, fact_path, f"{tables}/fact_price_quarantine", f"{checkpoints}/fact_price_quarantine")
    spec = dimensions.PRODUCT_HISTORY
    history.run_history(spark, fact_path, schema, f"{tables}/dim_product", f"{checkpoints}/dim_product", spec)
    distinct.run_categories(
        read_table_stream(spark, fact_path, schema), f"{tables}/dim_category", f"{checkpoints}/dim_category"
    )
    daily.run_daily(spark, fact_path, schema, f"{tables}/fact_price_daily", f"{checkpoints}/fact_price_daily")
    for name, mart in kept.KEPT_MARTS.items():
        kept.run_mart(spark, mart, fact_path, schema, f"{tables}/{name}", f"{checkpoints}/{name}")

    fact = facts.fact_table(spark, fact_path)
    small = {"dim_retailer": dimensions.dim_retailer(spark), "dim_date": dimensions.dim_date(fact)}
    marts = {name: kept.current(spark, mart, f"{tables}/{name}", schema) for name, mart in kept.KEPT_MARTS.items()}
    done = marts | {name: write_table(df, f"{tables}/{name}") for name, df in small.items()} | {
        "fact_price": fact,
        "expectation_log": expectation_log(spark, f"{fact_path}_log"),
        "fact_price_quarantine": read_table(spark, f"{tables}/fact_price_quarantine", schema),
        "fact_price_daily": daily.current(spark, f"{tables}/fact_price_daily", schema),
        "dim_product": history.current(spark, f"{tables}/dim_product", schema, spec),
        "dim_category": distinct.current(spark, f"{tables}/dim_category", fact.select(*dimensions.CATEGORY).schema),
    }
    if catalogue:
        enter(spark, done, catalogue, tables)
    return done


def enter(spark: SparkSession, done: dict[str, DataFrame], catalogue: str, tables: str) -> None:
    """Enter the tables of ``DESCRIBED`` into a database of the catalogue.

    The fact is entered where it lies. The others, aggregates and dimensions, are stored as
    states that their readers finish, so their finished rows are written.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalogue}")
    for name, (tier, comment) in DESCRIBED.items():
        entry, properties = f"{catalogue}.{name}", {TIER: tier}
        if name == "fact_price":
            catalogue_parts(spark, entry, f"{tables}/{name}", FACT_SCHEMA, comment, properties)
        else:
            catalogue_table(done[name], entry, comment, properties)
