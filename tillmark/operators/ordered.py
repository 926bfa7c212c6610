"""Previous and next row within a key, whatever share of all rows one key holds.

A window over a key puts all its rows into one task. Here rows are dealt by ranges of (key,
order) instead, with bounds that Spark samples when the query runs: a large key spans many
ranges, small keys share one, and an outlier cannot crowd the others. A window over each range
finds the neighbours inside it. The first and last row of a key in a range, two at most, find
theirs by a second window over such rows alone; all other rows are dealt by hash in that step.

Every row takes this one path, null keys and null order values (which come first) included,
and nothing runs while the query is built.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.session import shuffles_released

RANGE = "_range"
# Copies of one row that travel as one counted row; only bounds what one task writes at a time.
COPIES_PER_BLOCK = 1_000_000
# The share of all rows that is looked at for busy keys, and how many of those rows make a key busy.
SEEN_SHARE, BUSY_SEEN = 0.01, 100
# Keys beyond the busiest ones hold less than a thousandth of the rows each.
MOST_BUSY = 1_000


def same_key(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_k{i}")) for i, key in enumerate(keys)])


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows dealt by ranges of (key, order), in order, with the number of their range."""
    if RANGE in df.columns:
        raise ValueError(f"a column named {RANGE} is in the way")
    return df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(RANGE, F.spark_partition_id())


def neighbours(
    df: DataFrame, keys: list[str], order: list[str], previous: dict[str, str], following: dict[str, str]
) -> DataFrame:
    """Add columns of the row before (``previous``) and after (``following``) per key.

    Both map a new column to the column it is taken from. ``df`` comes from ``ranged``, whole or
    filtered, and ``order`` is unique per key.
    """
    before, after = _row(previous), _row(following)
    near_before, near_after, far_before, far_after, slot = free_names(df, "_before", "_after", "_range_before", "_range_after", "_slot")
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order)
    near = df.select("*", F.lag(before).over(inside).alias(near_before), F.lead(after).over(inside).alias(near_after))
    at_border = F.col(near_before).isNull() | F.col(near_after).isNull()
    across = Window.partitionBy(*keys, slot).orderBy(*order)
    met = near.withColumn(slot, F.when(~at_border, F.col(RANGE))).select(
        "*", F.lag(before).over(across).alias(far_before), F.lead(after).over(across).alias(far_after)
    )
    return met.select(
        *[F.col(f"`{name}`") for name in df.columns],
        *[F.coalesce(near_before, far_before)[out].alias(out) for out in previous],
        *[F.coalesce(near_after, far_after)[out].alias(out) for out in following],
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken, found = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """``neighbours`` of rows in any place."""
    return neighbours(ranged(df, keys, order), keys, order, previous or {}, following or {}).drop(RANGE)


def digests(df: DataFrame, columns: list[str], name: str) -> dict[str, Column]:
    """What stands for some columns where only their equality counts: two hashes of 64 bits, or the
    values themselves if one of them is nested. Nulls are values like any other; so are NaN and
    negative zero, which equal themselves and zero."""
    if any(isinstance(df.schema[column].dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)) for column in columns):
        return {f"{name}0": F.struct(*[F.col(f"`{column}`") for column in columns])}
    parts = [part for column in columns for part in (F.col(f"`{column}`"), F.col(f"`{column}`").isNull())]
    return {f"{name}{turn}": F.xxhash64(F.lit(turn), *parts) for turn in range(2)}


@dataclass(frozen=True)
class BusyKeys:
    """Keys with so many rows that no single task should take one; ``found`` holds their digests."""

    keys: list[str]
    found: DataFrame | None

    def without(self, df: DataFrame) -> DataFrame:
        """Rows of all other keys."""
        return df if self.found is None else self._met(df, "left_anti")

    def among(self, df: DataFrame) -> DataFrame | None:
        """Rows of the busy keys; None if there are no such keys."""
        return None if self.found is None else self._met(df, "left_semi")

    def _met(self, df: DataFrame, how: str) -> DataFrame:
        named = digests(df, self.keys, "__KEY")
        return df.withColumns(named).join(F.broadcast(self.found), list(named), how).drop(*named)


def busy_keys(df: DataFrame, keys: list[str], share: float = SEEN_SHARE, busy_seen: int = BUSY_SEEN) -> BusyKeys | None:
    """The keys that a sample of the rows shows to be busy, ``MOST_BUSY`` at most; None if it shows no rows.

    Runs a job over the key columns. Which keys are found decides where rows go, not what comes out.
    """
    named = digests(df, keys, "__KEY")
    picked = df.select(*[column.alias(name) for name, column in named.items()]).sample(share, 1)
    counted = picked.groupBy(*named).agg(F.count(F.lit(1)).alias("_seen")).orderBy(F.desc("_seen")).limit(MOST_BUSY)
    with shuffles_released(df.sparkSession):
        seen = counted.collect()
    busy = [tuple(row)[:-1] for row in seen if row["_seen"] >= busy_seen]
    if not seen:
        return None
    return BusyKeys(keys, df.sparkSession.createDataFrame(busy, picked.schema) if busy else None)


def with_previous_value(
    df: DataFrame, key: str, sequence: str, value: str, into: str, copies_per_block: int = COPIES_PER_BLOCK
) -> DataFrame:
    """Add ``value`` of the row before, per ``key``, ordered by ``sequence`` then ``value``.

    Rows equal in both are ordered by their remaining columns, so that the result does not
    depend on how the rows arrive. Copies of a row are counted before the shuffle, travel as
    blocks and are written out again at the end, where only the first one looks back.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    copies, block, found, copy = free_names(df, "_copies", "_block", "_found", "_copy")
    rest = sorted(name for name in df.columns if name not in (key, sequence, value))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
    last_block = F.floor((F.col(copies) - 1) / copies_per_block)
    blocks = counted.select(*columns, copies, F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias(block))
    looked = with_neighbours(blocks, [key], [sequence, value, *rest, block], {found: value})
    here = F.least(F.lit(copies_per_block).cast("long"), F.col(copies) - F.col(block) * copies_per_block)
    rows = looked.select(*columns, found, F.explode(F.sequence(F.lit(1).cast("long"), here)).alias(copy))
    return rows.select(*columns, F.when(F.col(copy) == 1, F.col(found)).otherwise(F.col(value)).alias(into))


def _row(sources: dict[str, str]) -> Column:
    """Struct of the wanted columns; never NULL itself, so it tells "no row" from "NULL"."""
    return F.struct(F.lit(True).alias("_present"), *[F.col(name).alias(out) for out, name in sources.items()])
