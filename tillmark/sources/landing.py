"""Landing: bring messily named files into one folder per retailer and date."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.sources.files import copy_file, qualified
from tillmark.sources.raw_files import list_files

UNCLASSIFIED, SUPERSEDED = "cannot classify", "superseded"


def retailer_of(name: Column) -> Column:
    """Retailer folder a file name points to: the first mark it contains."""
    lowered = F.lower(name)
    return F.coalesce(*[F.when(lowered.contains(mark), folder) for mark, folder in fixed.FILE_NAME_MARKS])


def date_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, fixed.FILE_DATE, 1), F.lit(""))


def landing_plan(files: DataFrame, prefix: str) -> DataFrame:
    """Where each file of ``files(path)`` goes, or the reason why it goes nowhere.

    Columns source, retailer, date, target, reason. Of several files with one target, the
    last by path is landed.
    """
    name = F.substring_index("path", "/", -1)
    named = files.select(F.col("path").alias("source"), retailer_of(name).alias("retailer"), date_of(name).alias("date"))
    clear = F.col("retailer").isNotNull() & F.col("date").isNotNull()
    place = F.concat_ws(
        "/",
        F.lit(prefix.rstrip("/")),
        F.col("retailer"),
        F.concat(F.lit("date="), F.col("date")),
        F.concat("retailer", F.lit("_"), "date", F.lit(".csv")),
    )
    planned = named.withColumn("target", F.when(clear, place))
    columns = ("source", "retailer", "date", "target")
    unclear = planned.filter(~clear).select(*columns, F.lit(UNCLASSIFIED).alias("reason"))
    placed = planned.filter(clear)
    last = placed.groupBy("target").agg(F.max("source").alias("_last"))
    superseded = F.when(F.col("source") != F.col("_last"), SUPERSEDED)
    return placed.join(last, "target").select(*columns, superseded.alias("reason")).unionByName(unclear)


def land(spark: SparkSession, folder: str, prefix: str, report: str) -> DataFrame:
    """Copy all classifiable files of a folder to their places below ``prefix``.

    Tasks copy whole files, unchanged, so any size works. What was done is written to the
    table ``report``, and returned from there: the plan with the bytes copied.
    """
    plan = landing_plan(list_files(spark, folder), qualified(spark, prefix))
    tasks = spark.sparkContext.defaultParallelism
    schema = "source string, retailer string, date string, target string, reason string, bytes long"
    copied = plan.repartition(tasks, "source").mapInPandas(_copy, schema)
    copied.write.mode("overwrite").parquet(report)
    return spark.read.parquet(report)


def _copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = [copy_file(row.source, row.target) if row.reason is None else None for row in batch.itertuples()]
        yield batch.assign(bytes=pd.array(sizes, dtype="Int64"))
