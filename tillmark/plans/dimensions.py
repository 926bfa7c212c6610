"""Dimensions of the price model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.keys import date_key, hash_key
from tillmark.operators.history import HistorySpec, scd2

PRODUCT_HISTORY = HistorySpec(
    keys=("product_sk",),
    sequence="snapshot_date",
    tracked=("product_name", "brand", "package_size_raw", "canonical_l1", "canonical_l2"),
    leave_out=(
        "price_aud", "previous_price_aud", "on_special", "availability", "is_quarantined",
        "dq_action", "dq_reason", "_ingest_ts", "_source_file",
    ),
    prefer=("_source_file",),
)


def dim_product(fact: DataFrame) -> DataFrame:
    return scd2(fact, PRODUCT_HISTORY)


CATEGORY = ("category_sk", "canonical_l1", "canonical_l2")


def dim_category(fact: DataFrame) -> DataFrame:
    """One row per category."""
    return one_per_key(fact.select(*CATEGORY), ["category_sk"])


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One of the rows of each key. Copies go first, by a hash aggregate that combines before the
    shuffle, so only the different rows of a key are compared; of those the least is taken."""
    rest = [name for name in rows.columns if name not in keys]
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_rows"))
    if not rest:
        return counted.select(*rows.columns)
    # the sum keeps the optimizer from dropping the first aggregate, which a minimum does not need
    chosen = counted.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least"), F.sum("_rows").alias("_rows")).where("_rows > 0")
    return chosen.select(*[F.col(name) if name in keys else F.col(f"_least.{name}").alias(name) for name in rows.columns])


def dim_retailer(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(fixed.RETAILERS), "retailer string, parent_company string, retailer_type string")
    return rows.withColumn("retailer_sk", hash_key("retailer"))


def dim_date(fact: DataFrame) -> DataFrame:
    """Every day from the first to the last snapshot, without a round trip to the driver."""
    span = fact.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_day"))
    return days.select(
        "date_day",
        date_key("date_day").alias("date_sk"),
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day"),
        F.dayofweek("date_day").alias("day_of_week"),
        F.dayofweek("date_day").isin(1, 7).alias("is_weekend"),
    )
