"""Stored tables that are brought up to date part by part.

A version of such a table holds only the parts that a batch touched, each in a folder of its
own. A part either replaces what older versions hold of it, or adds to that if its name ends in
``MORE``. What a part holds now is its newest replacing folder and all folders added since. A
version counts once it is whole, so a batch that is repeated starts from the versions before
its own and overwrites.

The driver lists folders, at most two per part and version; rows stay in the tasks.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.sources import files

PART, MORE = "_part", "+"
NO_DATE = "none"


def bucket(keys: list[str], buckets: int) -> Column:
    """The part of a key when keys are dealt to a fixed number of parts."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def date_part(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd"), F.lit(NO_DATE))


def parts_of(df: DataFrame, part: Column) -> list[str]:
    """The parts that rows belong to: as many as buckets or dates, not as rows."""
    return sorted(row[0] for row in df.select(part.alias(PART)).distinct().collect())


def store(
    df: DataFrame, path: str, version: int, part: Column, together: bool = False, scattered: DataFrame | None = None
) -> list[str]:
    """Write the rows as one version, each to its part; returns the parts written.

    Rows of one part meet in one task, or in several when they are many, unless they lie
    ``together`` already. ``scattered`` are further rows, which do not.
    """
    rows = df.withColumn(PART, part)
    rows = rows if together else rows.hint("rebalance", PART)
    if scattered is not None:
        rows = rows.unionByName(scattered.withColumn(PART, part).hint("rebalance", PART))
    rows.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/v={version}")
    return sorted(_parts(df.sparkSession, path, version))


def read(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, only: Collection[str] | None = None
) -> DataFrame:
    """What the parts, or those of ``only``, hold as of the newest version, or as of the newest
    one older than ``before``."""
    held = folders(spark, path, before)
    return _table(spark, [one for part in sorted(held if only is None else set(only) & set(held)) for one in held[part]], schema)


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int) -> DataFrame:
    """The rows that one version wrote."""
    return _table(spark, [f"{path}/v={version}/{PART}={part}" for part in _parts(spark, path, version)], schema)


def folders(spark: SparkSession, path: str, before: int | None = None) -> dict[str, list[str]]:
    """By part, the folders that make it up."""
    held: dict[str, list[str]] = {}
    for version in versions(spark, path):
        if before is not None and version >= before:
            break
        for name in _parts(spark, path, version):  # a part that replaces sorts before what adds to it
            part, folder = name.removesuffix(MORE), f"{path}/v={version}/{PART}={name}"
            held[part] = [*held.get(part, []), folder] if name.endswith(MORE) else [folder]
    return held


def versions(spark: SparkSession, path: str) -> list[int]:
    """Whole versions, oldest first."""
    found = [int(name[2:]) for name in files.subfolders(spark, path) if name.startswith("v=")]
    return sorted(number for number in found if files.exists(spark, f"{path}/v={number}/_SUCCESS"))


def tidy(spark: SparkSession, path: str, version: int) -> None:
    """Delete folders that neither the newest state nor the one before ``version`` needs."""
    needed = {one for before in (None, version) for part in folders(spark, path, before).values() for one in part}
    for number in versions(spark, path):
        for name in _parts(spark, path, number):
            if number < version and f"{path}/v={number}/{PART}={name}" not in needed:
                files.delete_folder(spark, f"{path}/v={number}/{PART}={name}")


def _parts(spark: SparkSession, path: str, version: int) -> list[str]:
    names = files.subfolders(spark, f"{path}/v={version}")
    return sorted(name.removeprefix(f"{PART}=") for name in names if name.startswith(f"{PART}="))


def _table(spark: SparkSession, chosen: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)
