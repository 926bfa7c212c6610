"""Change history (slowly changing dimension, type 2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.ordered import RANGE, busy_keys, digests, free_names, neighbours, ranged

START, END = "__START_AT", "__END_AT"
_GRAIN = "__GRAIN"
_LOOKS = ("now", "begin", "was", "will_be", "next", "opens", "closes", "begin_before", "end")


@dataclass(frozen=True)
class HistorySpec:
    """What a history follows.

    A new version starts when one of the ``tracked`` columns changes. Other columns show
    the last row of their version. ``leave_out`` columns are not kept; of several rows
    with one key and sequence the greatest by ``prefer``, then by all kept columns, counts.
    """

    keys: tuple[str, ...]
    sequence: str
    tracked: tuple[str, ...]
    leave_out: tuple[str, ...] = ()
    prefer: tuple[str, ...] = ()

    def kept(self, columns: list[str]) -> list[str]:
        return [name for name in columns if name not in self.leave_out]

    def stored(self, columns: list[str]) -> list[str]:
        """What must be stored of an observation, so that a later one can be compared with it."""
        return [name for name in columns if name not in self.leave_out or name in self.prefer]


def observations(df: DataFrame, spec: HistorySpec, kept: list[str] | None = None) -> DataFrame:
    """One row per key and sequence, pre-aggregated before the shuffle."""
    kept = spec.kept(df.columns) if kept is None else kept
    return _best(df, spec).select(*kept)


def _best(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """The best row per key and sequence, dealt by the digests of both, which are added."""
    stored = spec.stored(df.columns)
    rest = [name for name in stored if name not in (*spec.keys, spec.sequence, *spec.prefer)]
    rows = _with_grain(df.select(*stored), spec)
    best = Window.partitionBy(*_grains(rows)).orderBy(*[F.desc(name) for name in (*spec.prefer, *rest)])
    # the best of each task's rows is found before the shuffle
    return rows.withColumn("_place", F.row_number().over(best)).filter("_place = 1").drop("_place")


def _with_grain(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Add what stands for key and sequence, as it follows from the digests of the key."""
    named = digests(df, list(spec.keys), "__KEY")
    keyed = df.withColumns(named)
    return keyed.withColumns(digests(keyed, [*named, spec.sequence], _GRAIN)).drop(*named)


def _only_preferred(df: DataFrame, spec: HistorySpec) -> list[str]:
    """Columns that only tell which row counts."""
    return [name for name in df.columns if name in spec.leave_out]


def _grains(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name in (f"{_GRAIN}0", f"{_GRAIN}1")]


def versions(seen: DataFrame, spec: HistorySpec, start: str | None = None) -> DataFrame:
    """Versions of observations that are unique by key and sequence.

    ``start`` names a column with an earlier start of the version a row belongs to, for
    rows where that is known.

    A row opens a version if the row before differs, and closes one if the row after
    differs; the row after a closing one starts the next version. Those two kinds of rows
    alternate, so a closing row finds its start right before itself (or is it). Both looks use
    the same ranges.
    """
    keys, order = list(spec.keys), [spec.sequence]
    columns = [name for name in seen.columns if name != start]
    begin = F.coalesce(F.col(start), F.col(spec.sequence)) if start else F.col(spec.sequence)
    now = F.struct(*[F.col(name) for name in spec.tracked])
    marked = seen.select(*columns, now.alias("_now"), begin.alias("_begin"))
    marked = ranged(marked, keys, order)
    near = neighbours(marked, keys, order, {"_was": "_now"}, {"_will_be": "_now", "_next": spec.sequence})
    opens, closes = ~_same("_was"), ~_same("_will_be")
    borders = near.select(*columns, RANGE, "_begin", "_next", opens.alias("_opens"), closes.alias("_closes"))
    borders = borders.filter(F.col("_opens") | F.col("_closes"))
    paired = neighbours(borders, keys, order, {"_begin_before": "_begin"}, {})
    own_begin = F.when(F.col("_opens"), F.col("_begin")).otherwise(F.col("_begin_before"))
    return paired.filter("_closes").select(*columns, own_begin.alias(START), F.col("_next").alias(END))


def whole_versions(seen: DataFrame, spec: HistorySpec, start: str | None = None) -> DataFrame:
    """The same, found over narrow rows with digests for the key and the tracked columns. Whole
    rows travel at most once, to meet the closing ones among those."""
    seen = seen if _grains(seen) else _with_grain(seen, spec)
    columns = [name for name in seen.columns if name not in (start, *_grains(seen), *_only_preferred(seen, spec))]
    named, now = digests(seen, list(spec.keys), "__KEY"), digests(seen, list(spec.tracked), "__NOW")
    known = [F.col(start).alias("__KNOWN")] if start else []
    narrow = seen.select(*[column.alias(name) for name, column in (named | now).items()], spec.sequence, *known)
    closing = versions(narrow, HistorySpec(tuple(named), spec.sequence, tuple(now)), "__KNOWN" if start else None)
    met = digests(closing, [*named, spec.sequence], _GRAIN)
    closing = closing.select(*[column.alias(name) for name, column in met.items()], START, END)
    return seen.select(*columns, *met).join(closing, list(met)).select(*columns, START, END)


def best_order(spec: HistorySpec, stored: list[str]) -> list[Column]:
    """The order in which the best row of a key and sequence comes first among those of both."""
    rest = [name for name in stored if name not in (*spec.keys, spec.sequence, *spec.prefer)]
    return [F.col(spec.sequence), *[F.desc(name) for name in (*spec.prefer, *rest)]]


def best_together(rows: DataFrame, spec: HistorySpec, group: list[str], stored: list[str]) -> DataFrame:
    """The best row per key and sequence, found in the task in which the rows of a ``group`` lie."""
    when, (before,) = F.struct(spec.sequence), free_names(rows, "_before")
    found = rows.withColumn(before, F.lag(when).over(Window.partitionBy(*group).orderBy(*best_order(spec, stored))))
    return found.where(~when.eqNullSafe(F.col(before))).drop(before)


def versions_together(
    rows: DataFrame, spec: HistorySpec, group: list[str], columns: list[str], begin: Column | None = None, end: Column | None = None
) -> DataFrame:
    """``versions`` with ``columns``, found in the task in which the rows of a ``group`` lie. ``begin`` is the
    start of a row's version if the row opens it. A row with an ``end`` is a whole version already."""
    order = Window.partitionBy(*group).orderBy(spec.sequence)
    now, since, was, will_be, following, opens, closes, since_before, ended = free_names(rows, *(f"_{name}" for name in _LOOKS))
    marked = rows.withColumns(
        {
            now: F.struct(*digests(rows, list(spec.tracked), "__NOW").values()),
            since: F.col(spec.sequence) if begin is None else begin,
            ended: F.lit(None).cast(rows.schema[spec.sequence].dataType) if end is None else end,
        }
    )
    looks = {was: F.lag(now), will_be: F.lead(now), following: F.lead(spec.sequence)}
    near = marked.withColumns({name: look.over(order) for name, look in looks.items()})
    differs = {opens: ~F.col(now).eqNullSafe(F.col(was)), closes: ~F.col(now).eqNullSafe(F.col(will_be))}
    borders = near.select(*rows.columns, since, ended, following, *[column.alias(name) for name, column in differs.items()])
    is_whole = F.col(ended).isNotNull()
    borders = borders.filter(F.col(opens) | F.col(closes) | is_whole).withColumn(since_before, F.lag(since).over(order))
    own_begin = F.when(F.col(opens) | is_whole, F.col(since)).otherwise(F.col(since_before))
    ends = F.coalesce(F.col(ended), F.col(following))
    return borders.filter(F.col(closes) | is_whole).select(*columns, own_begin.alias(START), ends.alias(END))


def scd2(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Full history of a table; the order of its rows does not matter.

    Whole rows are dealt once, by key, and all else is found in the task that a key's rows meet in. Rows
    of busy keys, and all rows if a sample tells nothing of the keys, are dealt by ranges instead.
    """
    keys = list(spec.keys)
    busy = busy_keys(df, keys)
    if busy is None:
        return whole_versions(_best(df, spec), spec)
    usual = busy.without(df.select(*spec.stored(df.columns)))
    found = versions_together(best_together(usual, spec, keys, usual.columns), spec, keys, spec.kept(usual.columns))
    rest = busy.among(df)
    return found if rest is None else found.unionByName(whole_versions(_best(rest, spec), spec))


def _same(neighbour: str) -> Column:
    return F.col("_now").eqNullSafe(F.col(neighbour))
