"""Batches stored together with the counts of what their checks dropped and missed.

The counts of a batch are a version of the log of their own: a repeated batch overwrites them,
so they are neither lost nor doubled, and every batch can be looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.quality import COUNTS, observed_counts
from tillmark.sources import parted

Judge = Callable[[DataFrame, Observation, Observation], DataFrame]
LOG_SCHEMA = f"batch long, {COUNTS}"


def store_checked(batch: DataFrame, judge: Judge, day: str, table: str, log: str, number: int) -> None:
    """Add what ``judge`` leaves of a batch to a table by date, and its counts to the log.

    ``judge`` is given the observations for the counts of expectations and of dropped rows. Rows
    of one date meet before they are written, so a batch adds one file per date, and more only
    where adaptive execution splits a date that is too large for one.
    """
    spark, seen, dropped = batch.sparkSession, Observation("expectations"), Observation("dropped")
    parted.store(judge(batch, seen, dropped), table, number, F.concat(parted.date_part(day), F.lit(parted.MORE)))
    counts = [(number, *row) for row in observed_counts(seen.get, dropped.get)]
    parted.store(spark.createDataFrame(counts, LOG_SCHEMA), log, number, F.lit(f"counts{parted.MORE}"))


def expectation_log(spark: SparkSession, log: str) -> DataFrame:
    """(batch, expectation, on_fail, passed, failed) of every batch stored so far."""
    return parted.read(spark, log, T.StructType.fromDDL(LOG_SCHEMA))
