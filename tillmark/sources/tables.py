"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmark.sources import files, parted

VERSION = "_version"
# Bounds the length of one statement.
PARTITIONS_AT_ONCE = 500


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace a stored table and read it back.

    Rows are brought together by partition value before the write; adaptive execution
    splits values that hold too many rows and joins small ones.
    """
    writer = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    # folders of parts only repeat what the rows hold
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def catalogue_table(
    df: DataFrame,
    name: str,
    comment: str,
    properties: dict[str, str] | None = None,
    partition_by: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Replace a catalogue table, with its comment and properties such as a quality tier.

    With a path, the rows lie there and stay when the table is dropped.
    """
    writer = df.write.mode("overwrite").format("parquet")
    writer = writer.option("path", path) if path else writer
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    return describe(df.sparkSession, name, comment, properties)


def catalogue_parts(
    spark: SparkSession, name: str, path: str, schema: T.StructType, comment: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """A catalogue table over the folders that make up a part-wise table now; no row is copied.

    Each folder is a partition of the table, by version and part, so a filter on ``_part`` reads
    only the parts asked for. Call it again after a batch: until then readers see the state before,
    which stays stored for one more batch.
    """
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, `{VERSION}` INT, `{parted.PART}` STRING) USING parquet"
        f" PARTITIONED BY (`{VERSION}`, `{parted.PART}`) LOCATION {_literal(path)}"
    )
    held = [folder for folders in parted.folders(spark, path).values() for folder in folders]
    for start in range(0, len(held), PARTITIONS_AT_ONCE):
        added = [_partition(folder) for folder in held[start : start + PARTITIONS_AT_ONCE]]
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
    return describe(spark, name, comment, properties)


def _partition(folder: str) -> str:
    version, part = folder.rsplit("/", 2)[1:]
    number, value = version.removeprefix("v="), part.removeprefix(f"{parted.PART}=").removesuffix(parted.MORE)
    return f"PARTITION (`{VERSION}`={number}, `{parted.PART}`={_literal(value)}) LOCATION {_literal(folder)}"


def describe(spark: SparkSession, name: str, comment: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Give a catalogue table its comment and properties."""
    spark.sql(f"COMMENT ON TABLE {name} IS {_literal(comment)}")
    for key, value in (properties or {}).items():
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_literal(key)} = {_literal(value)})")
    return spark.table(name)


def described(spark: SparkSession, name: str) -> tuple[str | None, dict[str, str]]:
    """The comment and the properties that the catalogue holds of a table."""
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return spark.catalog.getTable(name).description, properties


def publish(df: DataFrame, path: str, version: int) -> None:
    """Write one complete version of a small table; readers see it once it is whole.

    The version before stays for readers that have begun, older ones go.
    """
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    spark = df.sparkSession
    for old in _versions(spark, path):
        if old < version - 1:
            files.delete_folder(spark, f"{path}/v={old}")


def reset(spark: SparkSession, *paths: str) -> None:
    """Forget a stream's output and checkpoint, so that its next run starts over."""
    for path in paths:
        files.delete_folder(spark, path)


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest whole version, or the newest older than ``before``; None if there is none."""
    found = [v for v in _versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/v={max(found)}") if found else None


def _versions(spark: SparkSession, path: str) -> list[int]:
    named = [name for name in files.subfolders(spark, path) if name.startswith("v=")]
    return [int(name[2:]) for name in named if files.exists(spark, f"{path}/{name}/_SUCCESS")]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
