"""Change history kept up to date batch by batch, in buckets of keys.

Three stored tables lie below a history: ``seen`` holds the observations, added to bucket by
bucket; ``versions`` holds open versions, replaced, and closed ones, added; ``late`` names the
keys of a batch that reach back behind what is known of them. A batch reads the open versions
of the buckets it touches and writes those anew, together with the versions that it closes.
Only buckets with late keys have their closed versions read and written anew, those keys
rebuilt from their bucket's observations. The source table is never read again.

Whole rows are dealt twice, to the tasks that write them: those of the batch into ``seen``, and those
that versions follow from into ``versions``. Only rows of busy keys are dealt more often.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators.history import (
    END,
    START,
    HistorySpec,
    best_order,
    best_together,
    observations,
    versions_together,
    whole_versions,
)
from tillmark.operators.ordered import busy_keys, free_names
from tillmark.operators.pieces import PIECE, PIECE_ROWS, by_key
from tillmark.sources import parted
from tillmark.sources.tables import read_table_stream
from tillmark.streaming.late import late_keys, maybe_of_keys, of_keys
from tillmark.streaming.runs import run_batches

# Parts of a history's tables. It must not change while a history is kept up.
BUCKETS = 64


def run_history(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    history: str,
    checkpoint: str,
    spec: HistorySpec,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Bring the versions at ``history`` up to date with the stored table.

    A repeated micro-batch starts from the state before its own and writes the same again.
    """

    def update(batch: DataFrame, number: int) -> None:
        bring_up_to_date(batch, history, number, spec, buckets)

    return run_batches(read_table_stream(spark, table, schema, files_per_batch), update, checkpoint)


def bring_up_to_date(
    batch: DataFrame, history: str, number: int, spec: HistorySpec, buckets: int = BUCKETS, piece_rows: int = PIECE_ROWS
) -> None:
    spark, keys = batch.sparkSession, list(spec.keys)
    part = parted.bucket(keys, buckets)
    seen, stored, late = (f"{history}/{name}" for name in ("seen", "versions", "late"))

    known = batch.select(*spec.stored(batch.columns)).schema
    schema = history_schema(batch.schema, spec)
    kept = spec.kept(known.names)
    where = F.concat(part, F.lit(parted.MORE))
    busy = busy_keys(batch, keys)
    if busy is None:
        touched = parted.store(observations(batch, spec, known.names), seen, number, where)
    else:
        everywhere = [str(bucket) for bucket in range(buckets)]
        usual = by_key(busy.without(batch.select(*known.names)), keys, part, everywhere, batch.count(), piece_rows)
        usual = best_together(usual, spec, [PIECE, *keys], known.names).select(*known.names)
        rest = busy.among(batch)
        rest = None if rest is None else observations(rest, spec, known.names)
        touched = parted.store(usual, seen, number, where, together=True, scattered=rest)
    fresh = parted.read_version(spark, seen, known, number)
    touched = [name.removesuffix(parted.MORE) for name in touched]

    still_open = parted.read(spark, stored, schema, number, [f"{name}-open" for name in touched])
    back = parted.store(late_keys(fresh, still_open, keys, spec.sequence), late, number, part)
    named = parted.read_version(spark, late, T.StructType([known[key] for key in keys]), number)
    before = parted.read(spark, seen, known, number, back) if back else None
    closed = parted.read(spark, stored, schema, number, [f"{name}-closed" for name in back]) if back else None

    tables = _Tables(fresh, still_open, named, before, closed)
    adds = F.when(part.isin(back), F.lit("-closed")).otherwise(F.lit(f"-closed{parted.MORE}"))
    where = F.concat(part, F.when(F.col(END).isNull(), F.lit("-open")).otherwise(adds))
    held = [one.select(*keys) for one in (fresh, still_open, before) if one is not None]
    busy = busy_keys(reduce(DataFrame.unionByName, held), keys)
    if busy is None:
        parted.store(_dealt_by_ranges(tables, spec, kept).select(*schema.names), stored, number, where)
    else:
        usual = _dealt_once(tables.each(busy.without), spec, kept, part, touched, piece_rows).select(*schema.names)
        rest = None if busy.found is None else _dealt_by_ranges(tables.each(busy.among), spec, kept).select(*schema.names)
        parted.store(usual, stored, number, where, together=True, scattered=rest)
    for path in (stored, late):
        parted.tidy(spark, path, number)


@dataclass(frozen=True)
class _Tables:
    """What the versions of the touched buckets follow from. The last two are there if keys are late:
    the observations of older batches and the closed versions, both of the buckets with late keys."""

    fresh: DataFrame
    still_open: DataFrame
    late: DataFrame
    before: DataFrame | None
    closed: DataFrame | None

    def each(self, change: Callable[[DataFrame], DataFrame]) -> _Tables:
        return _Tables(*[None if one is None else change(one) for one in (getattr(self, field.name) for field in fields(self))])


def _dealt_by_ranges(tables: _Tables, spec: HistorySpec, kept: list[str]) -> DataFrame:
    """The versions to write, whatever share of the rows one key holds."""
    keys, when = list(spec.keys), tables.fresh.schema[spec.sequence].dataType
    # an open version stands for all its rows: it is its last row, with a known start; keys that
    # share a bucket with the batch but have no row in it come out as they are
    carried = tables.still_open.select(*kept, F.col(START).alias("_start"))
    rows = carried.unionByName(tables.fresh.select(*kept).withColumn("_start", F.lit(None).cast(when)))
    if tables.before is not None:
        again = of_keys(tables.before.unionByName(tables.fresh), tables.late, keys)
        again = observations(again, spec, kept).withColumn("_start", F.lit(None).cast(when))
        rows = of_keys(rows, tables.late, keys, inside=False).unionByName(again)
    changed = whole_versions(rows, spec, "_start")
    return changed if tables.closed is None else changed.unionByName(of_keys(tables.closed, tables.late, keys, inside=False))


def _dealt_once(
    tables: _Tables, spec: HistorySpec, kept: list[str], part: Column, parts: list[str], piece_rows: int
) -> DataFrame:
    """The same with all rows of a key in one task: they are dealt once, to the pieces of their part.
    A mark for each late key lies among them; of such a key the older observations count, not its versions."""
    keys, known = list(spec.keys), tables.fresh.columns
    kind, is_closed, is_late, began, ended = free_names(tables.fresh, "_kind", "_is_closed", "_is_late", "_began", "_ended")
    kinds = {"fresh": tables.fresh, "open": tables.still_open}
    if tables.before is not None:
        kinds |= {"late": tables.late, "before": tables.before, "closed": tables.closed}
    n_rows = sum(one.count() for one in kinds.values())
    if tables.before is not None:
        kinds["before"] = maybe_of_keys(tables.before, tables.late, keys)
    marked = [rows.withColumnsRenamed({START: began, END: ended}).withColumn(kind, F.lit(name)) for name, rows in kinds.items()]
    rows = reduce(lambda some, more: some.unionByName(more, allowMissingColumns=True), marked)
    rows = by_key(rows, keys, part, parts, n_rows, piece_rows)
    rows = rows.withColumn(is_closed, F.col(kind) == "closed")
    group = [PIECE, *keys, is_closed]
    if tables.before is not None:
        # one sort for this look and all others
        rows = rows.sortWithinPartitions(*group, *best_order(spec, known))
        counts = F.when(F.col(is_late), F.col(kind).isin("fresh", "before")).otherwise(F.col(kind).isin("fresh", "open", "closed"))
        rows = rows.withColumn(is_late, F.max(F.col(kind) == "late").over(Window.partitionBy(PIECE, *keys))).where(counts)
        rows = best_together(rows, spec, group, known)
    # a closed version is as it was, also if it began at no known time
    begin = F.when(F.col(is_closed), F.col(began)).otherwise(F.coalesce(F.col(began), F.col(spec.sequence)))
    return versions_together(rows, spec, group, kept, begin, F.when(F.col(is_closed), F.col(ended)))


def history_schema(source: T.StructType, spec: HistorySpec) -> T.StructType:
    when = source[spec.sequence].dataType
    kept = [source[name] for name in spec.kept(source.names)]
    return T.StructType([*kept, T.StructField(START, when), T.StructField(END, when)])


def current(spark: SparkSession, history: str, source: T.StructType, spec: HistorySpec) -> DataFrame:
    """All versions as of the last whole batch."""
    return parted.read(spark, f"{history}/versions", history_schema(source, spec))
