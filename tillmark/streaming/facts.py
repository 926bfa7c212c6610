"""The price fact as a stream: conform, judge, add."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators.quality import quarantined
from tillmark.plans.conform import conform_all
from tillmark.plans.fact import FACT_SCHEMA, fact_price
from tillmark.sources import parted
from tillmark.sources.feeds import FEEDS
from tillmark.streaming.checked import store_checked
from tillmark.streaming.ingest import raw_stream
from tillmark.streaming.runs import run_append, run_batches

DAY = "snapshot_date"
# Stored bytes of each raw table that one micro-batch takes, or one file if that is larger. A batch
# shuffles its conformed rows, some nine times as many bytes, and releases them when it is stored.
BYTES_PER_BATCH = 128 << 20


def run_fact(
    spark: SparkSession, raw: dict[str, str], fact: str, checkpoint: str, log: str | None = None, bytes_per_batch: int = BYTES_PER_BATCH
) -> StreamingQuery:
    """Add what is new in the raw tables to the fact, in as many batches as its size asks for; ``log`` (by
    default beside the fact) takes the counts of dropped rows and missed expectations of every batch."""
    streams = [(feed, raw_stream(spark, feed, raw[feed.folder], bytes_per_batch)) for feed in FEEDS]

    def store(batch: DataFrame, number: int) -> None:
        store_checked(batch, fact_price, DAY, fact, log or f"{fact}_log", number)

    return run_batches(conform_all(streams), store, checkpoint)


def fact_table(spark: SparkSession, fact: str, dates: list[str] | None = None) -> DataFrame:
    """The stored fact, or some dates of it."""
    return parted.read(spark, fact, FACT_SCHEMA, only=dates)


def fact_stream(spark: SparkSession, fact: str) -> DataFrame:
    return spark.readStream.schema(FACT_SCHEMA).option("recursiveFileLookup", "true").parquet(fact)


def run_quarantine(spark: SparkSession, fact: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    return run_append(quarantined(fact_stream(spark, fact)), quarantine, checkpoint, partition_by=DAY)
