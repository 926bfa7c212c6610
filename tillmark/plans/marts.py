"""Daily price fact and the five marts, all recomputed in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.keys import date_key, hash_key
from tillmark.operators import measures as m
from tillmark.operators.ordered import with_previous_value
from tillmark.operators.quality import trusted

DAILY_COLUMNS = (
    "product_sk", "category_sk", "retailer_sk", "date_sk", "retailer", "source_sku", "product_name",
    "brand", "price_aud", "previous_price_aud", "prev_day_price", "price_change_pct", "unit_price_value",
    "unit_price_measure", "norm_unit_price", "norm_unit_measure", "on_special", "availability", "ratings",
    "canonical_l1", "canonical_l2", "product_url", "snapshot_date",
)
_DERIVED = ("retailer_sk", "date_sk", "prev_day_price", "price_change_pct")
# What the daily fact takes over; the source file only settles the order of rows that are otherwise alike.
DAILY_INPUTS = (*[name for name in DAILY_COLUMNS if name not in _DERIVED], "_source_file")


def fact_price_daily(fact: DataFrame) -> DataFrame:
    """Trusted prices with the change against the product's previous trusted price."""
    return with_daily_columns(looked_back(daily_inputs(trusted(fact)))).select(*DAILY_COLUMNS)


def daily_inputs(fact: DataFrame) -> DataFrame:
    return fact.select(*DAILY_INPUTS)


def looked_back(rows: DataFrame) -> DataFrame:
    return with_previous_value(rows, "product_sk", "snapshot_date", "price_aud", "prev_day_price")


def with_daily_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "price_change_pct": m.change_pct("price_aud", "prev_day_price"),
            "date_sk": date_key("snapshot_date"),
            "retailer_sk": hash_key("retailer"),
        }
    ).select(*DAILY_COLUMNS, "_source_file")


def mart_price_comparison(daily: DataFrame) -> DataFrame:
    """Retailers ranked by mean comparable unit price, per day and category."""
    return ranked_means(_mean_unit_price(daily, ["snapshot_date", "canonical_l1", "canonical_l2", "norm_unit_measure", "retailer"]))


def ranked_means(means: DataFrame) -> DataFrame:
    group = ["snapshot_date", "canonical_l1", "canonical_l2", "norm_unit_measure"]
    return m.with_rank(means, within=group, by="avg_norm_unit_price")


def mart_specials_penetration(daily: DataFrame) -> DataFrame:
    """Share of products on special, per day, retailer and category."""
    return with_specials_share(_added_up(daily, ["snapshot_date", "retailer", "canonical_l1"], specials_counts()))


def specials_counts() -> dict[str, Column]:
    return {"n_products": m.row_count(), "n_on_special": m.count_where(F.col("on_special"))}


def with_specials_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("specials_pct", m.share_pct("n_on_special", "n_products"))


def mart_category_price_index(daily: DataFrame) -> DataFrame:
    """Mean comparable unit price as an index to the first day, per retailer and category."""
    group = ["retailer", "canonical_l1", "norm_unit_measure"]
    means = _mean_unit_price(daily, ["snapshot_date", *group])
    return m.with_base_index(means, within=group, over="snapshot_date", value="avg_norm_unit_price")


def mart_availability(fact: DataFrame) -> DataFrame:
    """Share of listings that are available, per day and retailer; quarantined rows count."""
    return with_availability_rate(_added_up(fact, ["snapshot_date", "retailer"], availability_counts()))


def availability_counts() -> dict[str, Column]:
    status = F.col("availability")
    return {
        "n_listings": m.row_count(),
        "n_available": m.count_where(status == "available"),
        "n_unavailable": m.count_where(status == "unavailable"),
    }


def with_availability_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("availability_rate", m.share_pct("n_available", "n_listings"))


def mart_dq_scorecard(fact: DataFrame) -> DataFrame:
    """Rows, quarantined rows and rows without a price, per day and retailer."""
    return with_quality_shares(_added_up(fact, ["snapshot_date", "retailer"], quality_counts()))


def quality_counts() -> dict[str, Column]:
    return {
        "n_rows": m.row_count(),
        "n_quarantined": m.count_where(F.col("is_quarantined")),
        "n_null_price": m.count_where(F.col("price_aud").isNull()),
    }


def with_quality_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumn("quarantine_pct", m.share_pct("n_quarantined", "n_rows")).withColumn(
        "null_price_pct", m.share_pct("n_null_price", "n_rows")
    )


def _added_up(rows: DataFrame, group: list[str], sums: dict[str, Column]) -> DataFrame:
    return rows.groupBy(*group).agg(*[value.alias(name) for name, value in sums.items()])


def _mean_unit_price(daily: DataFrame, group: list[str]) -> DataFrame:
    return (
        daily.filter(F.col("norm_unit_price").isNotNull())
        .groupBy(*group)
        .agg(m.mean_2dp("norm_unit_price").alias("avg_norm_unit_price"), m.row_count().alias("n_products"))
    )
