"""Landing in runs: where each run's files go, what they replace there, and what every target holds.

The state is one row per target, kept in key buckets; a run reads and rewrites only the buckets
of its own targets. The log gets the rows of a run as a version of their own, so a repeated run
neither loses nor doubles them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.sources import parted
from tillmark.sources.landing import landing_plan
from tillmark.streaming.late import of_keys
from tillmark.streaming.runs import run_batches

BUCKETS = 16
LANDED = T.StructType().add("target", "string").add("source", "string").add("batch", "long")
LOG = reduce(
    lambda schema, name: schema.add(name, "string"), ("source", "retailer", "date", "target", "reason", "replaces"), T.StructType()
).add("batch", "long")


def run_landing(
    files: DataFrame, prefix: str, landed: str, log: str, checkpoint: str, buckets: int = BUCKETS
) -> StreamingQuery:
    """Plan the files of a stream ``files(path)`` that are new since the last run."""

    def update(batch: DataFrame, number: int) -> None:
        land_batch(batch, prefix, landed, log, number, buckets)

    return run_batches(files.select("path"), update, checkpoint)


def land_batch(files: DataFrame, prefix: str, landed: str, log: str, number: int, buckets: int = BUCKETS) -> None:
    """Log the plan of one run and bring the state up to date.

    A later run's file takes the target whatever its path; inside a run the last by path does.
    ``replaces`` names the other file that held the target before, NULL if there was none or if
    the same file lands again.
    """
    spark, part = files.sparkSession, parted.bucket(["target"], buckets)
    plan = landing_plan(files, prefix).withColumn("batch", F.lit(number).cast("long"))
    lands = F.col("target").isNotNull() & F.col("reason").isNull()
    taken = plan.filter(lands).select(*LANDED.names).distinct()
    held = parted.read(spark, landed, LANDED, number, parted.parts_of(taken, part))
    before = held.select("target", F.col("source").alias("_held"))
    replaces = F.when(lands, F.nullif("_held", "source")).alias("replaces")
    logged = plan.join(before, "target", "left").select(*[replaces if name == "replaces" else name for name in LOG.names])
    parted.store(logged, log, number, F.concat(part, F.lit(parted.MORE)))
    parted.store(of_keys(held, taken, ["target"], inside=False).unionByName(taken), landed, number, part)
    parted.tidy(spark, landed, number)


def landed_files(spark: SparkSession, landed: str) -> DataFrame:
    """The file that every target holds now, and the run that brought it."""
    return parted.read(spark, landed, LANDED)


def landing_log(spark: SparkSession, log: str) -> DataFrame:
    """What every run did with each of its files."""
    return parted.read(spark, log, LOG)
