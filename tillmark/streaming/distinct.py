"""Distinct rows of a stream, one per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.plans.dimensions import CATEGORY, one_per_key
from tillmark.sources import parted
from tillmark.streaming.late import of_keys
from tillmark.streaming.runs import run_batches

BUCKETS = 16


def run_distinct(stream: DataFrame, keys: list[str], table: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a table with one row of every key ever seen; there is no watermark, keys never expire."""

    def update(batch: DataFrame, number: int) -> None:
        add_new_keys(batch, keys, table, number, buckets)

    return run_batches(stream, update, checkpoint)


def add_new_keys(batch: DataFrame, keys: list[str], table: str, number: int, buckets: int = BUCKETS) -> None:
    """Add the rows whose key the table does not hold yet; it is its own state.

    Copies go before the shuffle, so a frequent key does not flood one task. Only the buckets
    of the batch's keys are read, and only new keys written.
    """
    spark, part = batch.sparkSession, parted.bucket(keys, buckets)
    rows = one_per_key(batch, keys)
    stored = parted.read(spark, table, batch.schema, number, parted.parts_of(rows, part))
    parted.store(of_keys(rows, stored, keys, inside=False), table, number, F.concat(part, F.lit(parted.MORE)))


def current(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return parted.read(spark, table, schema)


def run_categories(fact: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return run_distinct(fact.select(*CATEGORY), ["category_sk"], table, checkpoint)
