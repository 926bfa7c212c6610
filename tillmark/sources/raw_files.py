"""CSV feed files, read by column name whatever the layout of each file."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions import fixed_values as fixed
from tillmark.sources.feeds import RESCUED, FeedSpec, stored_name
from tillmark.sources.files import first_line

# The binary file source lists files; nobody selects the content, so it is never read.
_LISTING = "path string, modificationTime timestamp, length long, content binary"

# The line of a row that has more or fewer cells than its header, and one cell of a line.
_LINE = "_line"
_CELL = r'(?:^|,)("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'
_QUOTED = r'^"((?:[^"]++|"")*+)".*$'


def source_root(spark: SparkSession, default: str | None = None) -> str:
    """Root of the raw files, from the session's ``source.root`` if set."""
    root = spark.conf.get("source.root", default)
    if not root:
        raise ValueError("name the root of the raw files or set source.root")
    return root


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all CSV files below a folder, as a table."""
    return _csv_only(spark.read.format("binaryFile")).load(folder).select("path")


def new_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream, which remembers the files it has seen in its checkpoint."""
    reader = _csv_only(spark.readStream.format("binaryFile").schema(_LISTING))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path")


def read_feed(spark: SparkSession, feed: FeedSpec, files: DataFrame) -> DataFrame:
    """Raw rows of the given files: native columns by name, extras as JSON, and lineage.

    Tasks read the first line of each file. Files with the same header form one scan, so
    there are as many scans as layouts, and large files are split as usual. The list of
    paths passes through the driver, as that of any file scan does.
    """
    layouts = files.mapInPandas(_with_header, "path string, header string").groupBy("header")
    scans = [
        _read_layout(spark, feed, json.loads(layout.header), layout.paths)
        for layout in layouts.agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
        if layout.header != "[]"
    ]
    if not scans:
        return spark.createDataFrame([], feed.stored_schema())
    return reduce(DataFrame.unionByName, scans)


def _csv_only(reader):
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")


def _with_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        names = [next(csv.reader([first_line(path)]), []) for path in batch["path"]]
        yield batch.assign(header=[json.dumps(header) for header in names])


def _read_layout(spark: SparkSession, feed: FeedSpec, header: list[str], paths: list[str]) -> DataFrame:
    positions = [f"_c{i}" for i in range(len(header))]
    rows = (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in [*positions, _LINE]]))
        .option("columnNameOfCorruptRecord", _LINE)
        # a pruned reader does not count the cells of a row
        .option("columnPruning", "false")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("recursiveFileLookup", "true")
        .csv([re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in paths])
    )
    by_name = {}
    for position, name in zip(positions, header):
        by_name.setdefault(stored_name(name), position)
    known = [
        (F.col(by_name[name]) if name in by_name else F.lit(None).cast("string")).alias(name)
        for name in feed.stored_headers
    ]
    taken = {by_name[name] for name in feed.stored_headers if name in by_name}
    extra = [F.col(p).alias(name) for p, name in zip(positions, header) if p not in taken]
    # fields that are NULL are left out, so a row without extras gives "{}"
    named = F.to_json(F.struct(*extra)) if extra else F.lit("{}")
    rescued = F.nullif(joined_json(named, F.coalesce(_surplus(F.col(_LINE), len(header)), F.lit("{}"))), F.lit("{}"))
    if not extra:  # Spark refuses to read the line alone, so the first cell is asked for as well
        rescued = F.when(F.col(_LINE).isNotNull() | F.col(positions[0]).isNotNull(), rescued)
    path = F.col("_metadata.file_path")
    return rows.select(
        *known,
        rescued.alias(RESCUED),
        path.alias("_source_file"),
        F.current_timestamp().alias("_ingest_ts"),
        F.try_to_date(F.regexp_extract(path, fixed.FOLDER_DATE, 1)).alias("_snapshot_date"),
    )


def _surplus(line: Column, width: int) -> Column:
    """The cells of a line beyond its header as JSON, named by position; empty ones are NULL
    and left out."""

    def entry(cell: Column, place: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"'))
        value = F.when(cell.rlike(_QUOTED), inner).otherwise(F.nullif(cell, F.lit("")))
        return F.struct(F.concat(F.lit("_c"), (place + width).cast("string")).alias("key"), value.alias("value"))

    cells = F.regexp_extract_all(line, F.lit(_CELL), F.lit(1))
    beyond = F.transform(F.slice(cells, F.lit(width + 1), F.greatest(F.size(cells) - width, F.lit(0))), entry)
    return F.to_json(F.map_from_entries(F.filter(beyond, lambda one: one["value"].isNotNull())))


def joined_json(left: Column, right: Column) -> Column:
    """The fields of two JSON objects in one."""
    both = F.concat(F.left(left, F.length(left) - 1), F.lit(","), F.substr(right, F.lit(2)))
    return F.when(left == "{}", right).when(right == "{}", left).otherwise(both)
