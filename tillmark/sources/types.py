"""Column types found from text, and cells that do not fit them.

Every cell is of one class; a column's classes so far are a set, kept as the bits of a number.
Sets of rows, files and batches are united by a bitwise or, in any order and as often as wanted,
so what has been found can be stored and added to. The type is the least one that takes in all
classes of the set: whole numbers widen to doubles, dates to timestamps, all others to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.staged import staged
from tillmark.functions.text import is_empty, strip_plain
from tillmark.operators.ordered import free_names
from tillmark.sources import parted
from tillmark.sources.feeds import RESCUED
from tillmark.sources.raw_files import joined_json

BOOLEAN, INT, LONG, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << place for place in range(7))
# The first type whose classes hold the whole set is the column's.
_TYPES = (
    ("string", 0),
    ("boolean", BOOLEAN),
    ("int", INT),
    ("bigint", INT | LONG),
    ("double", INT | LONG | DOUBLE),
    ("date", DATE),
    ("timestamp", DATE | TIMESTAMP),
)
_WHOLE = r"^[+-]?\d{1,19}$"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_MOMENT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
# Words that a cast takes for a boolean; characters that no cell has which a cast takes for a whole number.
_TRUE_OR_FALSE = ("t", "true", "y", "yes", "1", "f", "false", "n", "no", "0")
_NO_WHOLE = r"[^0-9+\-\x00-\x20\x7f]"
MASKS = "file string, column string, mask int"


def cell_class(text: Column) -> Column:
    """The class of a stripped cell. Most words are told from numbers and dates by their first
    character, so that no pattern is tried on them."""
    may_be_number = (text >= "+") & (text < ":")  # plus, comma, minus, point, slash, digits
    whole = F.when(text.try_cast("int").isNotNull(), INT).when(text.try_cast("bigint").isNotNull(), LONG).otherwise(DOUBLE)
    return (
        F.when(is_empty(text), 0)
        .when(~may_be_number, F.when(F.lower(text).isin("true", "false"), BOOLEAN).otherwise(TEXT))
        .when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_DECIMAL) & text.try_cast("double").isNotNull(), DOUBLE)
        .when(text.rlike(_DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )


def type_masks(rows: DataFrame, columns: list[str], file: Column | None = None) -> DataFrame:
    """The classes of every column, by file: one aggregate over all columns, combined before the
    shuffle."""
    texts = [strip_plain(F.col(f"`{name}`")).alias(f"_{place}") for place, name in enumerate(columns)]
    classes = [cell_class(F.col(f"_{place}")).alias(f"_{place}") for place in range(len(columns))]
    stripped = rows.select((F.lit("") if file is None else file).alias("file"), *texts)
    masks = stripped.select("file", *classes).groupBy("file").agg(
        *[F.bit_or(f"_{place}").alias(f"_{place}") for place in range(len(columns))]
    )
    pairs = [F.struct(F.lit(name).alias("column"), F.col(f"_{place}").alias("mask")) for place, name in enumerate(columns)]
    return masks.select("file", F.inline(F.array(*pairs)))


def merged_types(masks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, column, type) over all files."""
    united = masks.groupBy(*by, "column").agg(F.bit_or("mask").alias("mask"))
    found = F.lit("string")
    for name, classes in reversed(_TYPES):
        found = F.when(F.col("mask").bitwiseAND(F.lit(~classes)) == 0, name).otherwise(found)
    return united.select(*by, "column", found.alias("type"))


def learn(rows: DataFrame, columns: list[str], path: str, number: int) -> None:
    """Add what a batch shows of its columns to the stored classes of a feed."""
    masks = type_masks(rows, columns, F.col("_source_file"))
    parted.store(masks, path, number, F.lit(f"masks{parted.MORE}"))


def learned(spark: SparkSession, path: str) -> dict[str, str]:
    """The types found so far; a row per column comes to the driver."""
    masks = parted.read(spark, path, T.StructType.fromDDL(MASKS))
    return {row.column: row.type for row in merged_types(masks).collect()}


def typed(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as the given types. A cell that does not fit its type is NULL and kept, by
    its column's name, in the rescued data; blank cells are NULL."""
    wanted = {name: kind for name, kind in types.items() if name in raw.columns and kind != "string"}
    if not wanted:
        return raw
    texts, cells = (free_names(raw, *[f"_{kind}_{place}" for place in range(len(wanted))]) for kind in ("text", "cell"))
    found = staged(
        raw,
        [
            {text: strip_plain(F.col(f"`{name}`")) for text, name in zip(texts, wanted)},
            {cell: _cast(F.col(text), kind) for cell, text, kind in zip(cells, texts, wanted.values())},
        ],
    )
    misfits = [
        F.when((F.col(text) != "") & F.col(cell).isNull(), F.col(f"`{name}`")).alias(name)
        for text, cell, name in zip(texts, cells, wanted)
    ]
    before = F.coalesce(F.col(RESCUED), F.lit("{}")) if RESCUED in raw.columns else F.lit("{}")
    rescued = F.nullif(joined_json(before, F.to_json(F.struct(*misfits))), F.lit("{}"))
    typed = {name: F.col(cell) for name, cell in zip(wanted, cells)}
    return found.withColumns(typed | {RESCUED: rescued}).drop(*texts, *cells)


def _cast(text: Column, kind: str) -> Column:
    """The stripped text as a type, NULL where it is none. A cast that fails costs many times one that
    does not, so blank cells and texts with other characters than the type has are not tried."""
    if kind == "boolean":
        return F.when(F.lower(text).isin(*_TRUE_OR_FALSE), text.try_cast(kind))
    if kind in ("int", "bigint"):
        return F.when((text != "") & ~text.rlike(_NO_WHOLE), text.try_cast(kind))
    return F.when(text != "", text.try_cast(kind))
