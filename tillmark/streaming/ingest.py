"""Incremental ingestion of feed files into raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillmark.sources.feeds import FEEDS, FeedSpec
from tillmark.sources.files import exists
from tillmark.sources.raw_files import new_files, read_feed
from tillmark.sources.types import learn
from tillmark.streaming.runs import run_batches

# Bounds the list of paths that one micro-batch passes through the driver.
FILES_PER_BATCH = 10_000


def ingest(
    spark: SparkSession,
    feed: FeedSpec,
    folder: str,
    table: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    types: str | None = None,
) -> StreamingQuery:
    """Read the files that are new since the last run into the raw table; ``types`` names a place
    where the classes of their cells are added up (``sources.types.learned`` tells the types).

    Each micro-batch owns one folder of the table and overwrites it when it is repeated,
    so no row is lost or doubled.
    """

    def store(files: DataFrame, batch: int) -> None:
        read_feed(spark, feed, files).write.mode("overwrite").parquet(f"{table}/batch={batch}")
        if types:
            learn(spark.read.schema(feed.stored_schema()).parquet(f"{table}/batch={batch}"), feed.stored_headers, types, batch)

    return run_batches(new_files(spark, folder, files_per_batch), store, checkpoint)


def ingest_all(spark: SparkSession, root: str, tables: str, checkpoints: str) -> dict[str, str]:
    """Ingest every feed below ``root``; returns the raw table of each feed.

    A feed that has not landed anything yet gets an empty raw table.
    """
    paths = {feed.folder: f"{tables}/raw_{feed.folder}" for feed in FEEDS}
    for feed in FEEDS:
        folder, table = f"{root}/{feed.folder}", paths[feed.folder]
        if exists(spark, folder):
            ingest(spark, feed, folder, table, f"{checkpoints}/raw_{feed.folder}")
        if not exists(spark, table):
            spark.createDataFrame([], feed.stored_schema()).write.parquet(f"{table}/batch=none")
    return paths


def raw_table(spark: SparkSession, feed: FeedSpec, table: str) -> DataFrame:
    return spark.read.schema(feed.stored_schema()).option("recursiveFileLookup", "true").parquet(table)


def raw_stream(spark: SparkSession, feed: FeedSpec, table: str, bytes_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(feed.stored_schema()).option("recursiveFileLookup", "true")
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_batch))
    return reader.parquet(table)
