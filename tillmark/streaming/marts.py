"""Marts kept up to date batch by batch, date by date.

A mart stores mergeable sums beside its columns. A batch is added up by the mart's keys, the sums
of the dates it touches are read and merged with it, and those dates are written anew. The
price index also keeps the base price of every group: a batch that changes a base, because an
earlier day arrived or the first day was completed, has all dates of that group written anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators import measures as m
from tillmark.operators.ordered import same_key
from tillmark.operators.quality import trusted
from tillmark.plans import marts
from tillmark.sources import parted
from tillmark.sources.tables import read_table_stream
from tillmark.streaming.runs import run_batches

DAY = "snapshot_date"


@dataclass(frozen=True)
class KeptMart:
    """A mart over ``keys`` (the date among them) from additive ``sums`` of fact rows."""

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    sums: Callable[[], dict[str, Column]]
    finished: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]
    base_of: tuple[str, ...] = ()  # groups whose first date is the base of an index

    def added_up(self, fact: DataFrame) -> DataFrame:
        return self.rows(fact).groupBy(*self.keys).agg(*[value.alias(name) for name, value in self.sums().items()])

    def merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        both = one.unionByName(other)
        names = list(self.sums())
        kinds = {name: one.schema[name].dataType for name in names}
        return both.groupBy(*self.keys).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in names])


def _priced(fact: DataFrame) -> DataFrame:
    return trusted(fact).filter(F.col("norm_unit_price").isNotNull())


def _mean_sums() -> dict[str, Column]:
    return {"_sum": m.exact_sum("norm_unit_price"), "n_products": m.row_count()}


COMPARISON = KeptMart(
    _priced,
    (DAY, "canonical_l1", "canonical_l2", "norm_unit_measure", "retailer"),
    _mean_sums,
    lambda sums: marts.ranked_means(sums.withColumn("avg_norm_unit_price", m.mean_of("_sum", "n_products"))),
    (DAY, "canonical_l1", "canonical_l2", "norm_unit_measure", "retailer", "avg_norm_unit_price", "n_products", "price_rank", "is_cheapest"),
)
SPECIALS = KeptMart(
    trusted, (DAY, "retailer", "canonical_l1"), marts.specials_counts, marts.with_specials_share,
    (DAY, "retailer", "canonical_l1", "n_products", "n_on_special", "specials_pct"),
)
AVAILABILITY = KeptMart(
    lambda fact: fact, (DAY, "retailer"), marts.availability_counts, marts.with_availability_rate,
    (DAY, "retailer", "n_listings", "n_available", "n_unavailable", "availability_rate"),
)
SCORECARD = KeptMart(
    lambda fact: fact, (DAY, "retailer"), marts.quality_counts, marts.with_quality_shares,
    (DAY, "retailer", "n_rows", "n_quarantined", "n_null_price", "quarantine_pct", "null_price_pct"),
)
PRICE_INDEX = KeptMart(
    _priced,
    (DAY, "retailer", "canonical_l1", "norm_unit_measure"),
    _mean_sums,
    lambda sums: sums.withColumn("avg_norm_unit_price", m.mean_of("_sum", "n_products")),
    (DAY, "retailer", "canonical_l1", "norm_unit_measure", "avg_norm_unit_price", "n_products", "base_price", "price_index"),
    base_of=("retailer", "canonical_l1", "norm_unit_measure"),
)
KEPT_MARTS = {
    "mart_price_comparison": COMPARISON,
    "mart_specials_penetration": SPECIALS,
    "mart_category_price_index": PRICE_INDEX,
    "mart_availability": AVAILABILITY,
    "mart_dq_scorecard": SCORECARD,
}


def run_mart(
    spark: SparkSession,
    mart: KeptMart,
    fact: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bring the mart at ``path`` up to date with the stored price fact."""

    def update(batch: DataFrame, number: int) -> None:
        bring_up_to_date(batch, mart, path, number)

    return run_batches(read_table_stream(spark, fact, schema, files_per_batch), update, checkpoint)


def bring_up_to_date(batch: DataFrame, mart: KeptMart, path: str, number: int) -> None:
    spark, day = batch.sparkSession, parted.date_part(DAY)
    rows, sums = f"{path}/rows", f"{path}/sums"
    # the batch's sums are stored first: the names of their folders are the dates touched
    fresh = mart.added_up(batch)
    state = fresh.schema
    dates = parted.store(fresh, sums, number, day)
    fresh = parted.read_version(spark, sums, state, number)
    stored = parted.read(spark, rows, _schema(spark, mart, batch.schema), number, dates).select(*state.names)
    merged = mart.finished(mart.merged(fresh, stored))
    if mart.base_of:
        merged = _indexed(spark, mart, merged, dates, path, number, batch.schema)
    parted.store(merged, rows, number, day)
    parted.tidy(spark, rows, number)
    parted.tidy(spark, sums, number)


def current(spark: SparkSession, mart: KeptMart, path: str, fact_schema: T.StructType) -> DataFrame:
    return parted.read(spark, f"{path}/rows", _schema(spark, mart, fact_schema)).select(*mart.columns)


def _indexed(
    spark: SparkSession, mart: KeptMart, touched: DataFrame, dates: list[str], path: str, number: int, fact_schema: T.StructType
) -> DataFrame:
    """Rows of the touched dates, and of all dates of groups whose base changed, with their index."""
    keys, price = list(mart.base_of), "avg_norm_unit_price"
    bases, rows = f"{path}/bases", f"{path}/rows"
    base_schema = T.StructType([*(touched.schema[name] for name in (*keys, DAY)), T.StructField("base_price", T.DoubleType())])
    before = parted.read(spark, bases, base_schema, number)
    whole = parted.date_part(DAY)
    # a base on a touched date is told anew by the merged rows of that date
    options = before.where(~whole.isin(dates)).unionByName(touched.select(*keys, DAY, F.col(price).alias("base_price")))
    first = options.groupBy(*keys).agg(F.min(F.struct(DAY, "base_price")).alias("_base"))
    parted.store(first.select(*keys, f"_base.{DAY}", "_base.base_price"), bases, number, F.lit("all"))
    now = parted.read(spark, bases, base_schema, number + 1)
    named = before.select(*[F.col(key).alias(f"_k{place}") for place, key in enumerate(keys)], F.col("base_price").alias("_was"))
    moved = now.join(named, same_key(keys)).where(~F.col("base_price").eqNullSafe(F.col("_was"))).select(*keys)
    moved = moved.select(*[F.col(key).alias(f"_k{place}") for place, key in enumerate(keys)])

    schema = _schema(spark, mart, fact_schema)
    others = [part for part in parted.folders(spark, rows, number) if part not in dates]
    stored = parted.read(spark, rows, schema, number, others)
    stale = sorted(row[0] for row in stored.join(moved, same_key(keys), "left_semi").select(whole).distinct().collect())
    again = parted.read(spark, rows, schema, number, stale).select(*touched.columns)
    base = now.select(*[F.col(key).alias(f"_k{place}") for place, key in enumerate(keys)], "base_price")
    joined = touched.unionByName(again).join(base, same_key(keys)).select(*touched.columns, "base_price")
    return joined.withColumn("price_index", m.index_of(price, "base_price"))


def _schema(spark: SparkSession, mart: KeptMart, fact_schema: T.StructType) -> T.StructType:
    done = mart.finished(mart.added_up(spark.createDataFrame([], fact_schema)))
    if mart.base_of:
        done = done.withColumns({"base_price": F.lit(0.0), "price_index": F.lit(0.0)})
    return done.schema
